"""Training-data operators: decontamination, quality rules, licence scans, URL filters, quality
classifier, language identification, packing, substring, line and near-duplicate removal, HTML extraction,
embedding whitening, spelling variants."""
