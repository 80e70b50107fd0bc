"""The pipeline against its stages done by brute force, and on odd tables."""

import hashlib

import pytest

import corpus_pipeline
from inspecta.llm import toxicity
from inspecta.llm.registry import piece_model
from tests.conftest import SF_CHECK
from tests.llm.test_operators import brute_components, brute_fingerprint, brute_leaks, sha

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with labels, copies, near copies and leaks."""
    out = str(tmp_path_factory.mktemp("corpus"))
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").orderBy("doc_id").limit(260).collect()]
    docs = [(i, t if t is None or len(t) < 6000 else t[:6000], *rest) for i, t, *rest in docs]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").orderBy("item_id").limit(6).collect()]
    long = next(t for _, t, *_ in docs if t and len(t) > 2500)
    docs += [(5000, None, "en", "s", 0), (5001, "", None, None, None), (5002, "", "en", "s", 0), (5003, docs[3][1], "en", "s", 1),
             (5004, long, "en", "s", 1), (5005, long + " tail", "en", "s", 1), (5006, "before " + (items[0][1] or "") + " after", "en", "s", 1),
             (None, "a row without an id", "en", "s", 1), (7, docs[7][1], "en", "s", 1)]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{SF_CHECK}/labels.parquet").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, docs, items


def brute(spark, folder):
    """What is left after each stage, as sorted lists of (doc_id, text)."""
    path, docs, items = folder
    every = spark.read.parquet(f"{path}/documents.parquet")
    score = toxicity.fit(every, spark.read.parquet(f"{path}/labels.parquet")).scorer()
    rows = [(i, t) for i, t, *_ in docs]
    left = [rows]
    left.append([(i, t) for i, t in rows if score(t) < 0.5])
    best = {}
    for i, t in left[-1]:
        k = t or ""
        if k not in best or (-1 if i is None else i) > (-1 if best[k][0] is None else best[k][0]):
            best[k] = (i, t)
    left.append(list(best.values()))
    fps = [brute_fingerprint(t or "") for _, t in left[-1]]
    comp = brute_components(fps, 4)
    low = {}
    for (i, _), c in zip(left[-1], comp):
        if i is not None:
            low[c] = min(i, low.get(c, i))
    left.append([(i, t) for (i, t), c in zip(left[-1], comp) if i is None or i == low[c]])
    leaked = {d for d, *_ in brute_leaks(left[-1], items)}
    left.append([(i, t) for i, t in left[-1] if i not in leaked])
    return left


def test_run_equals_stages_by_brute_force(spark, folder):
    import sentencepiece
    left = brute(spark, folder)
    assert len({len(x) for x in left}) >= 4         # the stages drop rows
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = []
    for i, t in left[-1]:
        ids = lib.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), sha(lib.decode(ids))))
    got = corpus_pipeline.run(spark, folder[0]).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got))) == sorted(map(repr, want))


def test_each_stage_keeps_columns_and_drops_what_it_should(spark, folder):
    left = brute(spark, folder)
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    key = lambda rows: sorted(repr((i, t or "")) for i, t in rows)       # noqa: E731
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], left[1:]):
        out = stage(spark, docs, folder[0])
        assert out.columns == docs.columns, name
        assert key((r.doc_id, r.text) for r in out.collect()) == key(want), name
        docs = corpus_pipeline.stored(out, f"test-{name}")


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    for name, schema in (("documents", COLUMNS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
