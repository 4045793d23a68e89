"""Operator 6: main text of pages by boosted trees over DOM-node features.

Trees trained here (on generated pages with known main text) give each block
element the probability that it is or holds main text; a tree-wide decoding picks
the likeliest choice without a kept node under a dropped one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import picked, table
from meeple.llm.html_dom import Page, decoded, features
from meeple.llm.html_pages import labelled_pages

PAGES = 1000  # generated pages that the model is trained on
TREES, DEPTH, RATE, BINS = 60, 5, 0.2, 32
RIDGE = 1.0


@dataclass
class Trees:
    """Complete trees of one depth in arrays: feature and bound per inner node, value per leaf."""
    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    bound: np.ndarray
    value: np.ndarray  # trees x 2^depth


def margins(x: np.ndarray, trees: Trees) -> np.ndarray:
    out = np.full(len(x), trees.base)
    rows = np.arange(len(x))
    inner = trees.feature.shape[1]
    for f, t, v in zip(trees.feature, trees.bound, trees.value, strict=True):
        at = np.zeros(len(x), np.int64)
        while at.size and at[0] < inner:  # all rows are on one level
            at = 2 * at + 1 + (x[rows, f[at]] > t[at])
        out += v[at - inner]
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Second-order boosting of the logistic loss with histogram splits."""
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    inner = 2 ** depth - 1
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            where = at - first
            best = np.full(width, 1e-6)
            choice = np.zeros(width, np.int64), np.full(width, BINS)
            whole_g = np.bincount(where, g, minlength=width)
            whole_h = np.bincount(where, h, minlength=width)
            for j in range(k):
                if not len(cuts[j]):
                    continue
                cell = where * (BINS + 1) + binned[:, j]
                left_g = np.bincount(cell, g, minlength=width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                left_h = np.bincount(cell, h, minlength=width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                right_g, right_h = whole_g[:, None] - left_g, whole_h[:, None] - left_h
                gain = (left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE)
                        - (whole_g ** 2 / (whole_h + RIDGE))[:, None])[:, :len(cuts[j])]
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                better = top > best
                best = np.where(better, top, best)
                choice[0][better], choice[1][better] = j, cut[better]
            for i in range(width):
                if choice[1][i] < BINS:
                    out.feature[t, first + i] = choice[0][i]
                    out.bound[t, first + i] = cuts[choice[0][i]][choice[1][i]]
            at = 2 * at + 1 + (x[np.arange(n), out.feature[t][at]] > out.bound[t][at])
        leaf = at - inner
        out.value[t] = rate * np.bincount(leaf, g, minlength=inner + 1) / (
            np.bincount(leaf, h, minlength=inner + 1) + RIDGE)
        margin += out.value[t][leaf]
    return out


class _Marked(Page):
    """A generated page; remembers which nodes are marked as main text."""

    def __init__(self, html: str):
        self.marked: list[bool] = [True]
        super().__init__(html)

    def handle_starttag(self, tag, attrs):
        n = len(self.tags)
        super().handle_starttag(tag, [(k, v) for k, v in attrs if k != "data-main"])
        if len(self.tags) > n:
            self.marked.append(any(k == "data-main" for k, _ in attrs))


def training_pages(n: int, seed: int = 7) -> list[_Marked]:
    return [_Marked(p.replace("*>", " data-main>")) for p in labelled_pages(n, seed)]


@functools.cache
def train(n: int = PAGES, seed: int = 7) -> Trees:
    pages = training_pages(n, seed)
    x = features(pages)
    y = np.concatenate([np.array(p.marked, float) for p in pages])
    return fit(x, y)


def _texts(pages: list[Page], trees: Trees) -> list[str]:
    if not pages:
        return []
    p = 1 / (1 + np.exp(-margins(features(pages), trees)))
    out, end = [], 0
    for page in pages:
        start, end = end, end + len(page.tags)
        kept = decoded(page, p[start:end])
        out.append("\n".join(t for node, t, _ in page.runs if kept[node]))
    return out


def _extracted(sent):
    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(*sent.value)
        for b in batches:
            html = b.column("html").to_pylist()
            texts: list[str] = []
            for i in range(0, len(html), 64):  # nodes of 64 pages are scored at once
                texts.extend(_texts([Page(h) for h in html[i:i + 64]], trees))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return extracted


def main_texts(pages: DataFrame, n_training: int = PAGES) -> DataFrame:
    """One row per row of pages(page_id, url, html): page_id, url, text, n_chars.

    Null and empty html give the empty text. Repeated rows give a row each; an
    empty table gives none. Unclosed and misnested tags are taken as browsers
    take them in common cases; text outside any element belongs to the body.
    """
    pages = picked(pages, "page_id", "url", "html")
    t = train(n_training)
    sent = pages.sparkSession.sparkContext.broadcast((t.base, t.feature, t.bound, t.value))
    kinds = dict(pages.dtypes)
    return pages.withColumn("html", F.coalesce("html", F.lit(""))).mapInArrow(
        _extracted(sent), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
