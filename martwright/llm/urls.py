"""URL filter: host and path rules, and a character n-gram model for the rest.

A rule names a host and a path prefix; it fits the host and its subdomains, the
longest that fits decides. Other URLs go to a logistic regression on hashed
character n-grams of host and path, fitted in numpy on a small labelled URL
table (at most ``LABELLED_URLS`` rows).

A null URL, or one without ``://``, has empty host and path; no rule fits it and
the model judges its empty features, that is by the model's bias. Repeated rows
are judged alike, an empty table gives an empty result. Without labelled rows
of both verdicts every URL that no rule blocks is allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import mapped, picked

LABELLED_URLS = 10_000
FEATURES = 1 << 16
SIZES = (2, 3, 4)
ROUNDS = 60
RATE = 0.5
DECAY = 1e-4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str  # host and path, like ``example.com/en/``

    def fits(self, host: Column, path: Column) -> Column:
        site, slash, rest = self.name.partition("/")
        return ((host == site) | host.endswith(f".{site}")) & path.startswith(slash + rest)


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    after = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(pages: DataFrame, rules: list[Rule], carried: tuple[str, ...] = ("page_id",), url_column: str = "url") -> DataFrame:
    """The carried columns, host, path, rule and rule_verdict; the last two null where no rule fits."""
    host, path = url_parts(F.col("_url"))
    source = picked(pages, **{c: c for c in carried}, _url=url_column)
    parts = source.select(*carried, host.alias("host"), path.alias("path"))
    longest = sorted(rules, key=lambda r: -len(r.name))
    fits = [(r, r.fits(F.col("host"), F.col("path"))) for r in longest]
    first = lambda what: F.coalesce(F.lit(None).cast("string"), *(F.when(fit, what(r)) for r, fit in fits))
    return parts.withColumns({"rule": first(lambda r: r.name), "rule_verdict": first(lambda r: r.verdict)})


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of all rows end to end, and the row of each."""
    found, counts = [], []
    for host, path in zip(hosts, paths, strict=True):
        before = len(found)
        for seed, text in ((1, f"^{host}$"), (2, f"^{path}$")):
            raw = text.encode()
            found += [xxhash.xxh3_64_intdigest(raw[i : i + n], seed) for n in SIZES for i in range(len(raw) - n + 1)]
        counts.append(len(found) - before)
    buckets = (np.array(found, np.uint64) & np.uint64(FEATURES - 1)).astype(np.int64)
    return buckets, np.repeat(np.arange(len(counts)), counts)


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def block(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        buckets, row = features(hosts, paths)
        return _margins(self.weights, self.bias, buckets, row, len(hosts)) > 0


def _margins(weights: np.ndarray, bias: float, buckets: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    size = np.maximum(1, np.bincount(row, minlength=n))
    return bias + np.bincount(row, weights=weights[buckets], minlength=n) / np.sqrt(size)


def train(hosts: list[str], paths: list[str], block: np.ndarray) -> UrlModel:
    """Full-batch gradient descent with per-weight step sizes."""
    weights, bias, n = np.zeros(FEATURES), 0.0, len(hosts)
    if not n or block.all() or not block.any():
        return UrlModel(weights, 1.0 if n and block.all() else -1.0)
    buckets, row = features(hosts, paths)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=n)))
    squares, bias_squares = np.full(FEATURES, 1e-8), 1e-8
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-_margins(weights, bias, buckets, row, n))) - block
        slope = np.bincount(buckets, weights=(error * scale)[row], minlength=FEATURES) / n + DECAY * weights
        squares += slope**2
        weights = weights - RATE * slope / np.sqrt(squares)
        bias_squares += error.mean() ** 2
        bias -= RATE * error.mean() / np.sqrt(bias_squares)
    return UrlModel(weights, bias)


def fit(labelled: DataFrame) -> UrlModel:
    """From (host, path, verdict); beyond ``LABELLED_URLS`` rows the first in hash order are taken."""
    small = labelled.select("host", "path", "verdict").distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "verdict")
    rows = small.limit(LABELLED_URLS).collect()
    return train([r.host for r in rows], [r.path for r in rows], np.array([r.verdict == "block" for r in rows], bool))


def judge(parts: DataFrame, model: UrlModel) -> DataFrame:
    """``ruled`` rows with a verdict: the rule's, else the model's."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = np.array(batch.column("rule_verdict").to_pylist(), object)
            open_rows = np.flatnonzero(verdicts == None)  # noqa: E711
            if len(open_rows):
                rest = batch.select(["host", "path"]).take(pa.array(open_rows))
                block = model.block(rest.column("host").to_pylist(), rest.column("path").to_pylist())
                verdicts[open_rows] = np.where(block, "block", "allow")
            kept = batch.drop_columns(["rule_verdict"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(verdicts, pa.string())], names=[*kept.schema.names, "verdict"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields if f.name != "rule_verdict")
    return mapped(parts, judged, f"{types}, verdict string")
