"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rows import ascii_lower

# The labelled URL table, a parameter of the operator: (host and path, 1 to block).
LABELLED_URLS = (
    ("www.casino-royal.example.com/win/now", 1),
    ("casino-win.example.org/en/1", 1),
    ("best-casino.example.net/slots/free-spins", 1),
    ("online-slots.example.com/jackpot", 1),
    ("poker-bets.example.net/bonus", 1),
    ("free-bets.example.com/de/2", 1),
    ("m.sports-betting.example.org/odds/today", 1),
    ("lotto-win.example.net/claim-prize", 1),
    ("adult-x.example.org/en/7", 1),
    ("adult-videos.example.com/xxx/1", 1),
    ("xxx-cams.example.net/live", 1),
    ("blog.porn-tube.example.com/watch/3", 1),
    ("sexy-dates.example.org/join", 1),
    ("hot-escort.example.net/fr/4", 1),
    ("cheap-pills.example.com/order", 1),
    ("buy-viagra.example.net/cheap", 1),
    ("online-pharma.example.org/pills/no-prescription", 1),
    ("weight-loss-pills.example.com/buy", 1),
    ("spam-farm.example.com/links/9", 1),
    ("link-farm.example.net/seo-spam", 1),
    ("seo-backlinks.example.org/cheap-links", 1),
    ("www.spam-mail.example.com/es/5", 1),
    ("ads-track.example.net/click?id=1", 1),
    ("track.ads-network.example.com/pixel", 1),
    ("click-tracker.example.org/redirect", 1),
    ("adserver.example.net/banner/2", 1),
    ("popup-ads.example.com/win-prize", 1),
    ("payday-loans.example.net/fast-cash", 1),
    ("get-rich-quick.example.org/money", 1),
    ("free-crack.example.com/warez/keygen", 1),
    ("torrent-warez.example.net/download", 1),
    ("fake-watches.example.org/replica", 1),
    ("news.example.com/en/2020/politics", 0),
    ("www.example.org/en/12345", 0),
    ("blog.example.net/fr/24958", 0),
    ("m.example.com/de/9802.html", 0),
    ("library.example.org/catalogue/books", 0),
    ("docs.example.com/guide/install.html", 0),
    ("wiki.example.net/es/history", 0),
    ("www.weather.example.org/forecast/today", 0),
    ("recipes.example.com/bread/sourdough", 0),
    ("university.example.net/research/papers", 0),
    ("museum.example.org/de/exhibitions", 0),
    ("garden.example.com/plants/roses", 0),
    ("science.example.net/articles/42", 0),
    ("travel.example.org/fr/paris", 0),
    ("music.example.com/reviews/album", 0),
    ("health.example.net/clinic/opening-hours", 0),
    ("school.example.org/en/timetable", 0),
    ("sports.example.com/football/results", 0),
    ("shop.example.net/products/17", 0),
    ("forum.example.org/threads/8", 0),
    ("thion.example.com/en/101", 0),
    ("tionsh.example.net/fr/20768", 0),
    ("blog.therst.example.org/de/45348", 0),
    ("m.thened.example.com/es/7233/", 0),
    ("www.theand.example.net/en/42521", 0),
    ("nding.example.org/fr/1116.html", 0),
    ("ererth.example.com/en/2154", 0),
    ("hather.example.net/de/7848", 0),
    ("ofting.example.org/es/19441/", 0),
    ("entio.example.com/en/38791.html", 0),
)

#: (verdict, host, path): the longest rule that fits an URL decides over the method.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

BUCKETS = 1 << 14


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash sign or the end, A-Z lowered."""
    return ascii_lower(F.substring_index(_after(url), "/", 1))


def _after(url: Column) -> Column:
    """Host and path of an URL, without query and fragment; empty where there is no ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, F.lit("://"))
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    return F.substring_index(F.substring_index(rest, "?", 1), "#", 1)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash sign or the end."""
    both = _after(url)
    at = F.instr(both, F.lit("/"))
    return F.when(at > 0, F.substr(both, at)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, null where none does.

    A rule fits its host and all subdomains where the path starts with the rule's path; of two
    rules of one length the first listed wins.
    """
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    # Shorter rules go first, so that longer ones stand in front of them in the end.
    for verdict, rule_host, rule_path in sorted(reversed(tuple(rules)), key=lambda r: len(r[1]) + len(r[2])):
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        here = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        fits = F.when(here & F.startswith(path, F.lit(rule_path)), named).otherwise(fits)
    return fits["rule"], fits["verdict"]


def grams(text: str, least: int = 3, most: int = 5) -> np.ndarray:
    """Distinct buckets of the character n-grams of a host or path, with its ends marked."""
    marked = f"^{text}$"
    found = {
        zlib.crc32(marked[i : i + n].encode()) % BUCKETS
        for n in range(least, most + 1)
        for i in range(max(len(marked) - n + 1, 0))
    }
    return np.fromiter(found, np.int64, len(found))


def features(host: str, path: str) -> np.ndarray:
    """Buckets of both parts; the host's and the path's n-grams never meet."""
    return np.concatenate([grams(host), BUCKETS + grams(path)]).astype(np.int64)


def fit(labelled: Sequence[tuple[str, int]], rounds: int = 400, rate: float = 0.5, ridge: float = 1e-3):
    """(weights, bias) of the regression: full-batch gradient descent on mean-scaled features."""
    xs = [features(*_parted(url)) for url, _ in labelled]
    ys = np.array([label for _, label in labelled], float)
    weights, bias = np.zeros(2 * BUCKETS), 0.0
    for _ in range(rounds):
        margin = np.array([weights[x].sum() / np.sqrt(len(x)) for x in xs]) + bias
        slope = 1 / (1 + np.exp(-margin)) - ys
        gradient = ridge * weights
        for x, g in zip(xs, slope, strict=True):
            gradient[x] += g / np.sqrt(len(x)) / len(xs)
        weights -= rate * len(xs) / 8 * gradient
        bias -= rate * slope.mean()
    return weights, float(bias)


def _parted(url: str) -> tuple[str, str]:
    host, _, path = url.partition("/")
    return host, "/" + path.partition("?")[0].partition("#")[0]


def url_verdicts(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    labelled: Sequence[tuple[str, int]] = LABELLED_URLS,
    threshold: float = 0.5,
) -> DataFrame:
    """(id, host, path, rule, verdict, score): a verdict on every row's URL.

    The longest fitting rule decides; elsewhere the regression does, blocking from ``threshold``
    up.  The regression is fitted once, on the small labelled table, and travels as one array of
    fixed size (256 KB).  Only the id and the URL are read.

    * A null URL, or one without ``://``, has an empty host and path; no rule fits it and the score
      is that of empty text.
    * Rows that repeat an id, or have none, are judged one by one.
    * An empty table gives an empty table; further columns are not read.
    """
    weights, bias = fit(labelled)

    @F.pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        # Hosts repeat from page to page, so their sums are kept for a while.
        @lru_cache(maxsize=100_000)
        def host_sum(host: str) -> tuple[float, int]:
            x = grams(host)
            return float(weights[x].sum()), len(x)

        def one(host: str, path: str) -> float:
            total, n = host_sum(host)
            x = BUCKETS + grams(path)
            both = n + len(x)
            margin = (total + float(weights[x].sum())) / np.sqrt(both) if both else 0.0
            return float(1 / (1 + np.exp(-(margin + bias))))

        return pd.Series([one(h, p) for h, p in zip(hosts, paths, strict=True)], dtype=float)

    parted = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = parted.select("id", "host", "path", rule.alias("rule"), verdict.alias("_ruled"), score("host", "path").alias("score"))
    learned = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("id", "host", "path", "rule", F.coalesce("_ruled", learned).alias("verdict"), "score")
