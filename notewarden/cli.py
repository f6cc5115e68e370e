"""Command line: rewrite, index, links, concepts, search, gate, contents, filters.

    python -m notewarden.cli rewrite NOTE|DIR [--output DIR] [--state DIR] [--max-chars N] [--overlap N] [--retries N] [--glossary TEXT] [--spec FILE] [--json]
    python -m notewarden.cli index|links|concepts DIR [--output DIR]
    python -m notewarden.cli search WORDS DIR
    python -m notewarden.cli gate NOTE [--src SOURCE] [--score] [--prefs FILE] [--json]
    python -m notewarden.cli toc NOTE [--apply]
    python -m notewarden.cli lines|ebook --src FILE --out FILE [--rules FILE] [--keep-reading]

rewrite and gate --score ask the model behind NOTEWARDEN_URL and NOTEWARDEN_KEY; without one a rewrite keeps the text and there is no score.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from notewarden import config, prepare
from notewarden.operators import corpus, filters, model_stages, quality, rolling, segment, toc
from notewarden.sources import files, vcs


def _at_least(least: int):
    def number(text: str) -> int:
        if (n := int(text)) < least:
            raise argparse.ArgumentTypeError(f"must be at least {least}")
        return n

    return number


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="notewarden", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    modes = top.add_subparsers(dest="mode", required=True)
    p = modes.add_parser("rewrite")
    p.add_argument("input")
    p.add_argument("--output", default="")
    p.add_argument("--state", default="", help="folder of finished notes, units and replies; a later run goes on from there")
    p.add_argument("--max-chars", type=_at_least(100), default=segment.MAX_CHARS)
    p.add_argument("--overlap", type=_at_least(0), default=segment.OVERLAP)
    p.add_argument("--retries", type=_at_least(0), default=1)
    p.add_argument("--commit", action="store_true")
    p.add_argument("--glossary", default="")
    p.add_argument("--spec", default="")
    p.add_argument("--json", action="store_true")
    for mode in ("index", "links", "concepts"):
        p = modes.add_parser(mode)
        p.add_argument("input")
        p.add_argument("--output", default="")
        p.add_argument("--name", default="")
    p = modes.add_parser("search")
    p.add_argument("words")
    p.add_argument("input")
    p.add_argument("--top", type=_at_least(1), default=5)
    p = modes.add_parser("gate")
    p.add_argument("input")
    p.add_argument("--src", default="")
    p.add_argument("--score", action="store_true")
    p.add_argument("--prefs", default="")
    p.add_argument("--json", action="store_true")
    p = modes.add_parser("toc")
    p.add_argument("input")
    p.add_argument("--apply", action="store_true")
    for mode in ("lines", "ebook"):
        p = modes.add_parser(mode)
        p.add_argument("--src", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--rules", default="")
        p.add_argument("--keep-reading", action="store_true")
    return top


def _file(path: str) -> str | None:
    try:
        with open(path, encoding="utf-8", errors="replace") as f:
            return f.read().removeprefix("﻿")
    except OSError:
        return None


def _one(spark: SparkSession, **values) -> dict:
    """A one-row DataFrame of texts, as (name: text)."""
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))


def _value(spark: SparkSession, text: str, column) -> object:
    return _one(spark, text=text).select(column(F.col("text")).alias("x")).first()["x"]


def _show(df) -> list[dict]:
    rows = [json.loads(r.json) for r in files.report_json(df).collect()]  # a report for the console
    for r in rows:
        print(json.dumps(r, ensure_ascii=False))
    return rows


def _rewrite(spark: SparkSession, a: argparse.Namespace, call) -> int:
    """Rewrites a note, or all notes of a folder as one job."""
    many = os.path.isdir(a.input)
    text = None if many else _file(a.input)
    if text is None and not many:
        print(f"cannot read {a.input}", file=sys.stderr)
        return 1
    notes = files.notes(spark, a.input).select("path", "file", "text") if many else _one(spark, path=a.input, file=os.path.basename(a.input), text=text)
    spec = config.load(a.spec) if a.spec else None
    rewrite = model_stages.rewriter(call, spec, a.glossary) if call else rolling.echo
    version = json.dumps([spec, a.glossary, os.environ.get("NOTEWARDEN_REWRITE_MODEL", "")], sort_keys=True)
    done = rolling.process(notes, rewrite, model_stages.questions(call, spec) if call else None, a.max_chars, a.overlap, a.retries, state=a.state or None, version=version)
    done = done.withColumn("output", toc.build(F.col("output"))["text"])
    if many:
        if a.output:  # the job runs once; its report is read from what it wrote
            rel = files.below(F.col("path"), a.input).alias("rel")
            done.join(notes.select("path", rel, F.col("text").alias("source")), "path").write.mode("overwrite").parquet(os.path.join(a.output, "report"))
            done = spark.read.parquet(os.path.join(a.output, "report"))
            files.write_notes(done.where("error is null"), os.path.join(a.output, "notes"), "rel", "output", "source")
        return 0 if all(r["ok"] for r in _show(done.select("path", "ok", "issues", "units", "inferred", "low_conf", "error", "resumed"))) else 1
    row = done.first()
    if a.output and row.error is None:
        target = os.path.join(a.output, os.path.basename(a.input))
        files.write_text(target, row.output)
        files.write_text(os.path.join(a.output, "源数据", "转写.md"), text)
        if a.commit:
            vcs.commit_file(target, f"Rewrite {os.path.basename(target)}")
    if a.json:
        print(json.dumps({k: v for k, v in row.asDict().items() if k != "output"}, ensure_ascii=False))
    elif not a.output and row.error is None:
        print(row.output)
    else:
        print(row.error or "; ".join(row.issues) or "ok", file=sys.stderr)
    return 0 if row.ok else 1


def run(spark: SparkSession, a: argparse.Namespace, call=None) -> int:
    prepare(spark)
    call = call or config.caller_from()
    if a.mode == "rewrite":
        return _rewrite(spark, a, call)
    if a.mode in ("index", "links", "concepts", "search"):
        if not os.path.isdir(a.input):
            print(f"no folder {a.input}", file=sys.stderr)
            return 1
        notes = corpus.without_index(files.notes(spark, a.input))
    if a.mode == "index":
        rows = corpus.course_index(notes, F.lit(a.name or os.path.basename(a.input.rstrip("/")))).orderBy("section", "n").collect()
        if not rows:
            return 1
        files.write_text(os.path.join(a.output or a.input, corpus.INDEX_FILE), "\n".join(r.line for r in rows))
        return 0
    if a.mode == "links":
        report = corpus.validation(notes)
        _show(report.where("n_broken > 0 or size(relations_broken) > 0 or size(citations) > 0 or size(confidence) > 0"))
        return 0 if _show(corpus.validation_totals(report))[0]["ok"] else 1
    if a.mode == "concepts":
        files.write_pages(corpus.concept_pages(notes), a.output or os.path.join(a.input, "concepts"))
        return 0
    if a.mode == "search":
        return 0 if _show(corpus.search_latest(notes, a.words, a.top)) else 1
    if a.mode == "gate":
        note = _file(a.input)
        source = _file(a.src) if a.src else None
        if note is None:
            print(f"cannot read {a.input}", file=sys.stderr)
            return 1
        score = model_stages.score(call, note, None) if a.score and call else None
        pair = spark.createDataFrame([(a.input, note, source, bool(a.src))], "key string, note string, src string, given boolean")
        limits = quality.limits_of(config.load(a.prefs) if a.prefs else None)
        report = quality.gate_report(pair, "key", "note", "src", "given", (lambda c: F.lit(score)) if score is not None else None, limits).cache()
        if a.json:
            _show(report)
        else:
            print(quality.report_text(report, "key").first().text)
        return 0 if report.first()["pass"] else 1
    if a.mode == "toc":
        text = _file(a.input)
        if text is None:
            return 1
        new = _value(spark, text, lambda c: toc.build(c, refresh=a.apply)["text"])
        if not a.apply:
            print(new)
        elif new != text:
            files.write_text(a.input, new)
        return 0
    text = _file(a.src)
    if not text:
        return 2
    if a.mode == "ebook":
        found = _value(spark, text, lambda c: filters.drop_figures(c, a.keep_reading))
        out = found["text"]
    else:
        rules = {k: tuple(map(tuple, v)) if k == "skip" else tuple(v) if isinstance(v, list) else v for k, v in config.load(a.rules).items()}
        row = filters.filter_lines(_one(spark, doc=a.src, text=text), filters.LineRules(**rules)).first()
        out = row.text if row else ""
    if not out.strip():
        return 2
    files.write_text(a.out, out)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("notewarden").config("spark.ui.enabled", "false").getOrCreate()
    return run(spark, args)


if __name__ == "__main__":
    sys.exit(main())
