"""Operator 3: token counts by a map-side lookup in two tiers.

A first pass finds pre-tokens that are frequent everywhere; their token counts
go to all tasks in one bounded table. The second pass counts each text: what the
table lacks is encoded once per worker and kept in a bounded cache. No pre-token
is shuffled; the first pass sends each task's most frequent ones only, and what
it leaves out costs time, never a count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import heaviest, picked, pin, table, tokenizer_path, worker_state

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
FREQUENT = 50_000  # pre-tokens in the table that all tasks get
FROM_A_TASK = 20_000  # of them that one task may propose
HELD = 300_000  # distinct pre-tokens a worker holds at once
LONGEST = 64  # bytes of a pre-token that any table or cache holds: longer ones are encoded as they come


def load(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def specials(path: str) -> list[bytes]:
    """Added tokens are cut out of the raw text before anything else."""
    import json
    with open(path, encoding="utf-8") as f:
        return [t["content"].encode() for t in json.load(f)["added_tokens"]]


# A pre-token here is a run of bytes other than [\x20\x09-\x0D]. The vocabulary's
# normaliser makes a space of every such byte and its pre-tokenizer drops spaces,
# so the tokens of a text are those of its runs; runs with a special token's
# string are encoded as the library does by default, like all others.

def _propose(path: str, from_a_task: int, held: int):
    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for b in batches:
            for data in b.column("data").to_pylist():
                seen.update(data.split())
            if len(seen) > 2 * held:  # keep the heavier half; costs speed only
                seen = Counter(dict(seen.most_common(held)))
        top = [(w, n) for w, n in seen.most_common(from_a_task) if n > 1 and len(w) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())],
            names=["run", "n"])
    return propose


def lengths(path: str, runs: list[bytes]) -> list[int]:
    tok = worker_state(path, "tokenizer", lambda: load(path))
    # one by one: for a batch the library starts a thread per core in every worker, which
    # costs twice the CPU time where all cores have work
    return [len(tok.encode(r.decode(), add_special_tokens=False).ids) for r in runs]


def frequent_lengths(texts: DataFrame, path: str, size: int = FREQUENT) -> dict[bytes, int]:
    """The table of tier one: at most ``size`` runs of LONGEST bytes, and their token counts."""
    top = (texts.mapInArrow(_propose(path, FROM_A_TASK, HELD), "run binary, n bigint")
           .groupBy("run").agg(F.sum("n").alias("n")))
    runs = sorted(bytes(r.run) for r in heaviest(pin(top), "n", size).select("run").collect())
    return dict(zip(runs, lengths(path, runs), strict=True)) if runs else {}


def _count(path: str, table_of, limit: int, held: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table_of.value
        cache: dict[bytes, int] = worker_state(path, "lengths", dict)
        for b in batches:
            out = []
            for data in b.column("data").to_pylist():
                runs = data.split()
                got = list(map(known.get, runs))
                if None in got:
                    left = [r for r, n in zip(runs, got, strict=True) if n is None]
                    new = [r for r in dict.fromkeys(left) if r not in cache]
                    fresh: dict[bytes, int] = {}
                    if new:
                        if len(cache) + len(new) > held:
                            cache.clear()
                            new = list(dict.fromkeys(left))
                        fresh = dict(zip(new, lengths(path, new), strict=True))
                        cache.update((r, n) for r, n in fresh.items() if len(r) <= LONGEST)
                    out.append(sum(n for n in got if n is not None)
                               + sum(fresh[r] if r in fresh else cache[r] for r in left))
                else:
                    out.append(sum(got))
            n_tokens = pa.array(out, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), n_tokens,
                 pa.array([n > limit for n in out], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return count


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    Null text counts as empty (0 tokens). ``tokenizer`` is the path of a
    ``tokenizers`` file whose pre-tokenizer never joins across ASCII white space.
    Repeated rows give a row each; an empty table gives none.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = picked(docs, "doc_id", "text").select(
        "doc_id", F.octet_length(data).cast("long").alias("n_bytes"), data.alias("data"))
    known = docs.sparkSession.sparkContext.broadcast(frequent_lengths(rows.select("data"), path))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_count(path, known, limit, HELD),
                           f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
