"""URL filter: explicit rules first, then a logistic regression on hashed character n-grams of host and path.

The regression learns from a small labelled URL table (``LABELLED`` unless another is given; at most MAX_LABELLED
rows).  n-grams of 3 to 5 characters of the marked host and of the path are hashed into one vector, the two fields
with different seeds; the score is the logistic of the mean weight, scaled, plus a bias.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlab.llm.scratch import store

BITS = 15
GRAMS = (3, 4, 5)
MAX_LABELLED = 5000
EPOCHS, STEP, L2 = 60, 0.5, 1e-4
BLOCK_AT = 0.8  # a wrong block costs as much as four wrong passes
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The small labelled URL table.  Words of unwanted and of ordinary hosts and paths, spelt out as URLs.
UNWANTED = ("casino", "poker", "slots", "betting", "free-bets", "jackpot", "viagra", "cheap-pills", "pharma-sale", "adult",
            "xxx", "porn", "sexcam", "escort", "dating-hot", "spam-farm", "link-farm", "seo-links", "warez", "cracked",
            "torrent", "keygen", "malware", "phishing", "ads-track", "adserver", "click-track", "popunder", "banner-ads",
            "payday-loan", "quick-cash", "replica-watch", "win-prize", "lottery")
ORDINARY = ("news", "blog", "library", "museum", "school", "university", "research", "science", "history", "weather",
            "garden", "cooking", "travel", "music", "sport", "health", "city", "forum", "docs", "wiki", "journal",
            "archive", "books", "photo", "code", "learn", "shop", "radio", "theatre", "nature", "bank", "law", "maps",
            "thonth", "tionsh", "therer", "erenti", "ingand", "www", "m")
_HOSTS = ("{}.example.com", "www.{}.example.org", "blog.{}.example.net", "m.{}.example.edu")
_PATHS = ("/", "/en/1234", "/de/77.html", "/about", "/2021/05/item", "/fr/9?page=2")


def labelled() -> list[tuple[str, int]]:
    """(url, 1 unwanted or 0 ordinary): every word above with every host form, paths in turn."""
    out = []
    for label, words in ((1, UNWANTED), (0, ORDINARY)):
        for i, word in enumerate(words):
            for j, host in enumerate(_HOSTS):
                out.append((f"https://{host.format(word)}{_PATHS[(i + j) % len(_PATHS)]}", label))
    return out


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str  # the host and all its subdomains
    path: str  # how the path must begin

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: str | Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or no ://: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """(host, path, rule, rule_verdict) of distinct (host, path); rule is null where none fits, the longest wins.

    Equal lengths: the first in text order.  Each host brings its suffixes (as many as it has labels), which meet the
    rules in an equality join, so the work does not grow with hosts times rules.  An empty list fits nothing.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame([(r.host, r.path, r.text, r.verdict) for r in dict.fromkeys(rules)],
                                  "suffix string, begin string, rule string, rule_verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (urls.select("host", "path", F.explode(suffixes).alias("suffix")).join(table, "suffix")
            .where(F.col("path").startswith(F.col("begin")))
            .groupBy("host", "path").agg(F.max_by(F.struct("rule", "rule_verdict"),
                                                  F.struct(F.length("rule"), F.col("rule"))).alias("r")))
    return urls.join(fits, ["host", "path"], "left").select("host", "path", "r.rule", "r.rule_verdict")


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def buckets(host: str, path: str) -> np.ndarray:
    out = []
    for seed, text in ((1, f"^{host}$"), (2, f"{path}$")):
        b = text.encode("utf-8", "replace")
        out += [zlib.crc32(b[i:i + n], seed) for n in GRAMS for i in range(len(b) - n + 1)]
    return np.array(out or [0], np.int64) & ((1 << BITS) - 1)


def fit(examples: list[tuple[str, str, int]], seed: int = 1) -> Model:
    """Logistic regression on (host, path, label) by AdaGrad; the two labels weigh the same.

    One label only, or none: a model that says that label, or allows, for every URL.
    """
    w, bias = np.zeros(1 << BITS), 0.0
    y = np.array([e[2] for e in examples], float)
    if len(y) == 0 or y.min() == y.max():
        return Model(w, -5.0 if len(y) == 0 or y[0] == 0 else 5.0)
    x = [buckets(h, p) for h, p, _ in examples]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    g2, gb = np.full(1 << BITS, 1e-3), 1e-3
    rng = np.random.RandomState(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            at = x[i]
            p = 1 / (1 + np.exp(-np.clip(SCALE * w[at].mean() + bias, -30, 30)))
            g = weight[i] * (p - y[i])
            u, n = np.unique(at, return_counts=True)
            gw = g * SCALE * n / len(at) + L2 * w[u]
            g2[u] += gw ** 2
            w[u] -= STEP * gw / np.sqrt(g2[u])
            gb += g * g
            bias -= STEP * g / np.sqrt(gb)
    return Model(w, float(bias))


SCALE = 10.0


def train(labelled_urls: DataFrame | None = None, url_col: str = "url", label_col: str = "label") -> Model:
    """Fit on a labelled URL table (label 1: block), at most MAX_LABELLED rows by a hash of the url; none: LABELLED."""
    if labelled_urls is None:
        return fit([(*_parts(u), y) for u, y in labelled()])
    rows = (labelled_urls.select(F.col(url_col).alias("url"), F.col(label_col).cast("int").alias("label"))
            .where("url is not null and label is not null").distinct()
            .orderBy(F.xxhash64("url"), "url", "label").limit(MAX_LABELLED)
            .select(host_of("url"), path_of("url"), "label").collect())
    return fit([tuple(r) for r in rows])


def _parts(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    end = min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))
    return rest[:cut].translate(str.maketrans(_UPPER, _LOWER)), rest[cut:end]


def filter_urls(pages: DataFrame, rules: list[Rule], model: Model, id_col: str = "page_id", url_col: str = "url"
                ) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per input row; score is the method's.

    The distinct (host, path) are judged once and joined back.  Null URLs and such without :// have an empty host and
    path and get the method's verdict on those.  Other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    urls = store(match_rules(rows.select("host", "path").distinct(), rules), "op1-urls")
    shared = pages.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for b in batches:
            z = np.array([SCALE * weights[buckets(h, p)].mean() + bias for h, p in zip(
                b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True)], float)
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*b.schema.names, "score"])

    judged = urls.mapInArrow(run, "host string, path string, rule string, rule_verdict string, score double")
    own = F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")
    return rows.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")
