"""Registered queries of the subpackage and the pipeline's stages."""

import numpy as np
import pytest

import corpus_pipeline
from casework.llm import catalog, lines, packing, pii, quality, simhash
from casework.llm.common import tokenizer_path

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, name):
    from tests_support import duck, frame_hash, to_pandas_spark
    got = to_pandas_spark(catalog.QUERIES[name](spark, SF))
    want = duck(SF).execute(catalog.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert frame_hash(got) == frame_hash(want.astype(object).where(want.notna(), None))


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_stages_against_plain_steps(spark):
    """Each stage on the rows its predecessor kept, against a plain version."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before, out = at.collect(), stage(spark, at, SF)
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "quality":
            model = quality.train(docs, labels)
            want = {r["doc_id"] for r in before if model.scores([quality.encoder().passages(r["text"])])[0] >= 0.3}
            assert {r["doc_id"] for r in rows} == want and 0 < len(want) < len(before)
        if name == "line_dedup":
            seen, want = set(), {}
            for r in sorted(before, key=lambda r: r["doc_id"]):
                own, gone = r["text"].split("\n"), set()
                for p in range(len(own) - 2):
                    w = tuple(own[p:p + 3])
                    gone |= {p, p + 1, p + 2} if w in seen and "".join(w).strip(" ") else set()
                    seen.add(w)
                want[r["doc_id"]] = "\n".join(x for i, x in enumerate(own) if i not in gone)
            assert {r["doc_id"]: r["text"] for r in rows} == want
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "simhash":
            marks = simhash.fingerprints_of([r["text"] for r in before])
            root = list(range(len(before)))
            for i in range(len(before)):
                for j in np.flatnonzero(np.array([bin(int(m)).count("1") for m in marks[:i] ^ marks[i]]) <= 3):
                    a, b = root[i], root[j]
                    root = [min(a, b) if x in (a, b) else x for x in root]
            least = {}
            for r, k in zip(before, root):
                least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
            assert {r["doc_id"] for r in rows} == set(least.values()) and len(rows) == len(least)
        if name == "pii":
            field = pii.train()
            for b, r in zip(sorted(before, key=lambda r: r["doc_id"]), sorted(rows, key=lambda r: r["doc_id"])):
                base = pii.base_spans(b["text"])
                spans = base + pii.added_spans([b["text"]], [base], field)[0]
                assert r["text"] == pii.redacted(b["text"], spans)
        if name == "packing":
            assert sum(r["length"] for r in rows) == sum(
                {r["doc_id"]: r["doc_tokens"] for r in rows}.values()) and {r["doc_id"] for r in rows} == {r["doc_id"] for r in before}
        at = spark.createDataFrame(rows, out.schema).repartition(2)


def test_pipeline_on_awkward_rows(spark, docs, none):
    at, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
        kept.append(at.count())
        if name != "packing":
            assert at.columns == docs.columns
    rows = at.collect()
    assert kept[0] >= kept[1] == kept[2] + (kept[1] - kept[2]) and kept[1] == kept[0] and 0 < kept[3] == kept[2]
    assert sum(r["length"] for r in rows) == sum({(r["doc_id"], r["doc_tokens"]): r["doc_tokens"] for r in rows}.values())
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    at = none
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
    assert at.count() == 0
