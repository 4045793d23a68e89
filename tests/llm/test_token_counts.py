from llm_data import documents, empty, frame

from meeple.llm import token_counts
from meeple.llm.common import tokenizer_path


def test_matches_the_library(spark, monkeypatch):
    tok = token_counts.load(tokenizer_path(token_counts.TOKENIZER))
    want = sorted((str(d), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids))
                  for d, t, *_ in documents())
    for frequent, held in ((50_000, 400_000), (3, 20)):  # with full and with tiny tables
        monkeypatch.setattr(token_counts, "FREQUENT", frequent)
        monkeypatch.setattr(token_counts, "HELD", held)
        out = token_counts.token_counts(frame(spark)).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in out) and any(r.over_limit for r in out)


def test_empty(spark):
    assert token_counts.token_counts(empty(spark)).collect() == []
