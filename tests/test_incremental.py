"""Links and searches that read only what they touch, against a full run."""

import random

from oracle import SF
from pyspark.sql import functions as F

from notewarden.operators import corpus, search_index
from notewarden.plans import registry
from notewarden.streaming import incremental, links

NOTE = "path string, file string, text string"


def test_links_after_changes(spark, tmp_path):
    """After each of several changes the verdicts are those of a full run, and only touched links are judged."""
    rng = random.Random(3)
    state, notes = str(tmp_path / "state"), {}
    known = spark.createDataFrame([("outside",)], "target string")
    assert links.dangling(spark, state).count() == 0

    def text():
        return "\n".join(f"see [[{rng.choice(['n%d' % rng.randint(0, 24), 'n%d.md' % rng.randint(0, 24), 'outside', 'lost'])}]]" for _ in range(rng.randint(0, 4)))

    for step in range(4):
        changed = {f"{rng.choice('ab')}/n{i}.md": text() for i in rng.sample(range(25), 8 if step else 14)}
        gone = rng.sample(sorted(notes), 3) if step else []
        rows = [(p, p.split("/")[1], t) for p, t in changed.items()]
        verdicts = links.update(spark, state, spark.createDataFrame(rows, NOTE), spark.createDataFrame([(p,) for p in gone], "path string") if gone else None, known)
        judged = {r.path for r in verdicts.collect()}
        before = set(notes)
        notes |= changed
        for p in gone:
            notes.pop(p, None)
        full = spark.createDataFrame([(p, p.split("/")[1], t) for p, t in notes.items()], NOTE)
        want = corpus.dangling_links(full, corpus.known_targets(full).union(known))
        assert sorted(map(tuple, links.dangling(spark, state).collect())) == sorted(map(tuple, want.collect()))
        assert judged <= set(notes) and (step == 0 or before)
    quiet = links.update(spark, state, spark.createDataFrame([("c/new.md", "new.md", "[[lost]]")], NOTE), None, known)
    assert [tuple(r) for r in quiet.collect()] == [("c/new.md", 0, "lost", True)]


def test_search_index(spark, tmp_path):
    """The index gives the rows of a scan, ties and short words included, and reads pruned folders."""
    rng = random.Random(5)
    vocab = ["markov", "Markov chain", "of", "a", "chains", "marko", "汉字", "汉", "kov", "x", "the end"]
    rows = [(f"p{i:03}", f"f{i}.md", "\n".join(" ".join(rng.choices(vocab, k=rng.randint(0, 5))) for _ in range(rng.randint(0, 6)))) for i in range(120)] + [("q", "q.md", None)]
    notes = spark.createDataFrame(rows, NOTE)
    index = str(tmp_path / "index")
    search_index.build(notes, index)
    for query in ("markov", "markov of", "chain, 汉字 zzz", "a x", "the end kov", "nothing", "of chains marko 汉"):
        for k in (1, 5, 200):
            want = [tuple(r) for r in corpus.search(notes, query, k).collect()]
            assert [tuple(r) for r in search_index.search(spark, index, query, k).collect()] == want, query
    plan = search_index.bounds(spark, index, ["markov"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan


def test_search_index_keeps_words_once(spark, tmp_path):
    """Letter groups are kept for each distinct word, not for each text, and words between marks are found by their parts."""
    notes = spark.createDataFrame([(f"p{i}", f"f{i}.md", "the-thesis, (other)\nthe。Other" if i % 2 else "none") for i in range(40)], NOTE)
    index = str(tmp_path / "index")
    search_index.build(notes, index)
    words = spark.read.parquet(f"{index}/words")
    assert sorted(r.token for r in words.select("token").distinct().collect()) == ["none", "other", "the", "the-thesis"]
    assert words.groupBy("gram", "token").count().where("count > 1").count() == 0
    assert [tuple(r) for r in search_index.search(spark, index, "the hes", 7).collect()] == [tuple(r) for r in corpus.search(notes, "the hes", 7).collect()]


def test_links_read_texts_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    notes = spark.createDataFrame([(f"n/{i}.md", f"{i}.md", f"[[{i + 1}.md]]") for i in range(6)], NOTE)
    links.update(spark, str(tmp_path / "state"), notes.withColumn("text", seen.asNondeterministic()("text")))
    assert read.value == 6 and links.dangling(spark, str(tmp_path / "state")).count() == 1


def test_incremental_notes_compares_times_without_texts(spark, monkeypatch):
    seen, process = [], incremental.process
    monkeypatch.setattr(incremental, "process", lambda spark, notes, *rest: (seen.append(notes.columns), process(spark, notes, *rest)))
    registry.queries()["incremental_notes"](spark, SF)
    assert seen == [["k", "path", "mtime", "more"]] * 3
