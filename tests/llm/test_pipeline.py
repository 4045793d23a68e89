import sys

import corpus_pipeline as cp
from llm_data import documents, frame
from test_near_dedup import brute, near_copies
from test_toxicity import LABELS, marked

from meeple.llm import mixing, piece_fst, toxicity
from meeple.llm.common import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs, labels = marked(300)
    rows = docs + [(r[0] + 10_000 if r[0] is not None else None, *r[1:]) for r in documents()] + near_copies(groups=4)
    sf = str(tmp_path)
    frame(spark, rows).select(*COLUMNS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{sf}/labels.parquet")
    now = spark.read.parquet(f"{sf}/documents.parquet")

    def step(i):
        out = cp.STAGES[i][1](spark, now, sf)
        assert out.columns[:5] == COLUMNS and (i == 4 or out.columns == COLUMNS)
        path = f"{sf}/stage{i}"
        out.write.parquet(path)
        return spark.read.parquet(path)

    want = {(r.doc_id, r.predicted) for r in
            toxicity.toxicity(now, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    now = step(0)
    ids = [r.doc_id for r in now.select("doc_id").collect()]
    assert set(ids) == {d for d, p in want if p == 0} and any(p for _, p in want)

    import re
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first = {}
    for r in now.collect():
        k = norm(r.text)
        first[k] = min(first.get(k, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    now = step(1)
    kept = now.collect()
    assert sorted(norm(r.text) for r in kept) == sorted(first)
    assert all(first[norm(r.text)] == (r.doc_id is None, r.doc_id or 0) for r in kept)

    groups = brute([(r.doc_id, r.text) for r in kept])
    now = step(2)
    assert {r.doc_id for r in now.collect()} == {r.doc_id for r, (_, c) in zip(kept, groups, strict=True) if r.doc_id == c}

    copies = {r.doc_id: r.copies for r in mixing.mix(now).collect()}
    now = step(3)
    got = {}
    for r in now.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: n for d, n in copies.items() if n}

    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(piece_fst.MODEL))
    before = now.count()
    now = step(4)
    out = now.collect()
    assert len(out) == before
    assert all(r.ids == library.encode(r.text or "") and r.n_pieces == len(r.ids) for r in out)

    # run() does the same
    assert sorted(str(r.doc_id) for r in cp.run(spark, sf).collect()) == sorted(str(r.doc_id) for r in out)


def test_near_copies_without_ids_go(spark):
    from test_near_dedup import no_ids
    rows = frame(spark, no_ids()).select(*COLUMNS).withColumnRenamed("n_chars", "_row")
    kept = cp.drop_near_copies(spark, rows, "").collect()
    assert rows.columns == list(kept[0].asDict())
    # of three copies without ids one stays, of three with one id that one; texts without words stay
    assert sorted((str(r.doc_id), len(r.text or "") > 0) for r in kept) == [
        ("7000", True), ("7001", True), ("7002", True), ("7002", True), ("None", False), ("None", False)]


def test_empty_table(spark, tmp_path):
    sf = str(tmp_path)
    frame(spark, []).select(*COLUMNS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{sf}/labels.parquet")
    assert cp.run(spark, sf).collect() == []


def test_nothing_else_imports_the_subpackage():
    import pathlib
    root = pathlib.Path(cp.__file__).parent
    for p in [*(root / "meeple").rglob("*.py"), *(root / "tests").glob("*.py"), *(root / "tools").glob("*.py")]:
        if "llm" not in p.parts:
            assert "llm" not in p.read_text().replace("_llm", "").lower() or p.name == "__spark_entry__.py"
    assert "meeple.llm" in sys.modules
