"""The chain over a small folder of tables."""

import brute
import corpus_pipeline
import pytest
from test_operators import prose

from screenline.llm import mixing, sharding


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    import random

    from screenline.session import local_table

    rng = random.Random(21)
    folder = tmp_path_factory.mktemp("sf")
    item = prose(rng, 30)
    data = [(i, prose(rng, rng.randrange(40, 120)), "en", rng.choice("abc")) for i in range(150)]
    data += [(200 + i, data[i][1], "en", "a") for i in range(20)]
    data += [(300 + i, data[30 + i][1] + " end", "en", None) for i in range(20)]
    data += [(400 + i, prose(rng, 30) + " " + item + " " + prose(rng, 30), "en", "b") for i in range(10)]
    data += [(500 + i, " ".join(w + "##" for w in prose(rng, 60).split()), "en", "c") for i in range(60)]
    data += [(600, "too short", "en", "a"), (601, None, None, None), (602, "", "en", "a"), (None, prose(rng, 50), "en", "a")]
    rows = [(*d, len(d[1] or "")) for d in data]
    local_table(spark, rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{folder}/documents.parquet")
    labels = [(d[0], 0 if d[0] >= 500 else 1, 0) for d in data if d[0] is not None]
    local_table(spark, labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    local_table(spark, [(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), data


def test_stages(spark, sf_dir):
    folder, data = sf_dir
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/out-{i}")
        docs = spark.read.parquet(f"{folder}/out-{i}")
        left[name] = sorted(((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=str)
        assert docs.columns[: len(columns)] == columns
    good = [(d, t) for d, t, *_ in data if d is None or d < 500]
    assert left["quality_rules"] == sorted(good, key=str)
    want = brute.near_duplicates(good)
    one = [d for d, (_, _, kept) in zip(good, want.values(), strict=True) if kept]
    assert left["near_dedup"] == sorted(one, key=str)
    dirty = {d for d, *_ in brute.contained(one, [(1, brute_item(spark, folder))])}
    assert dirty == set(range(400, 410))
    assert left["decontamination"] == sorted(((d, t) for d, t in one if d not in dirty), key=str)
    clean = spark.read.parquet(f"{folder}/out-2")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(clean).collect()}
    got = {}
    for d, t in left["mixing"]:
        got[d] = got.get(d, 0) + len(brute.words(t))
    assert got == {d: n for d, n in taken.items() if n}
    assert left["sharding"] == left["mixing"]
    table = sharding.lookup_table(sharding.shard_names())
    assert all(r["shard"] == sharding.shard_names()[table[r["slot"]]] for r in docs.collect())


def brute_item(spark, folder):
    return spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]


def test_run(spark, sf_dir):
    folder, _ = sf_dir
    a, b = (sorted(map(str, corpus_pipeline.run(spark, folder).collect())) for _ in range(2))
    assert a == b
    assert a
