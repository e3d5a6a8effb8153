"""The corpus pipeline: each stage on its own input against its operator's brute force, and the whole run."""

import random

import __spark_entry__ as entry
import corpus_pipeline

from . import brute


def small_corpus():
    rng = random.Random(8)
    v = {"en": "the of and to in that is for on with as was at by this from", "de": "der die und in den von zu das mit sich des auf ist im dem nicht"}
    rows = []
    for i in range(160):
        la = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(v[la].split()) + rng.choice(["", "", "ing", "ung"]) for _ in range(rng.choice([10, 40, 80]))), la, f"s{i % 3}"))
    leak = " ".join(f"question{i} answer{i}" for i in range(12))
    passage = " ".join(f"the passage{i} of" for i in range(20))
    rows += [(500, rows[5][1], "de", "s1"), (501, rows[8][1] + " of", "en", "s1"), (502, None, "en", "s2"), (503, "123 !!", "en", "s2")]
    rows += [(504 + k, "the and of with " + rows[20 + 2 * k][1] + " " + passage, "en", "s0") for k in range(3)] + [(600, "this is for the " + leak + " that was by the", "en", None)]
    return rows, [(1, leak), (2, "something else that nobody holds in any text of the corpus at all")]


def test_stages(spark, tmp_path):
    rows, items = small_corpus()
    brute.documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    told = stages["language id"](spark, docs, str(tmp_path))
    assert told.columns == columns and {r["doc_id"] for r in told.select("doc_id").collect()} == {r[0] for r in rows} - {502, 503}
    rows = [r for r in rows if r[0] not in (502, 503)]

    single = stages["near-duplicate documents"](spark, told, str(tmp_path))
    groups = brute.near_groups([(r[0], r[1]) for r in rows], 5, 80)
    assert single.columns == columns and {r["doc_id"] for r in single.select("doc_id").collect()} == {i for i, (_, c) in groups.items() if i == c}
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    assert not {500, 501} & {r[0] for r in rows}

    cut = stages["substring dedup"](spark, single, str(tmp_path))
    want = brute.repeats_cut([(r[0], r[1]) for r in rows])
    got = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == columns and set(got) == {i for i, (n, gone, _) in want.items() if gone == 0 or gone < n}
    for r in rows:
        n, gone, _ = want[r[0]]
        if r[0] in got:
            assert len(got[r[0]]["text"].split()) == n - gone
            assert got[r[0]]["n_chars"] == len(got[r[0]]["text"])
            assert gone or got[r[0]]["text"] == r[1]
    assert any(want[i][1] for i in got)

    clean = stages["benchmark decontamination"](spark, cut, str(tmp_path))
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == set(got) - {600}

    mix = stages["mixing sources"](spark, clean, str(tmp_path))
    assert mix.columns == [*columns, "mix"] and mix.count() > 0

    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda df: sorted((r["doc_id"], r["text"], r["mix"]["copy"]) for r in df.collect())
    assert key(whole) == key(mix)


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert {"op2_near_dedup", "op4_mixing", "op8_url_filters"} <= set(entry.oracle_sql())
