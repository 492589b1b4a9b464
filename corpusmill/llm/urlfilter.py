"""URL filter: explicit host/path rules first, then logistic regression on hashed character n-grams.

The rules are Spark expressions. The classifier is fitted on the driver on a small labelled URL
table (at most ``MOST_LABELLED`` rows are taken, by hash of the url) by full-batch gradient
descent, so the weights do not depend on the order of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import mix

#: (host, path prefix, verdict) of the explicit rules.
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]

#: The labelled URL table that is used if none is passed: names of the kinds of sites that block lists and directories
#: name, drawn up from those kinds alone, each with some subdomains, under reserved suffixes and paths that tell nothing.
TO_BLOCK = (
    "roulette-online blackjack-room baccarat-live jackpot-slots lucky-slots poker-stars sportsbook-odds bookmaker-bonus lottery-draw bingo-hall wager-tips "
    "viagra-store cialis-shop pharmacy-discount rxmeds-online steroid-shop weightloss-miracle botox-deals porn-videos sexcams-live hotcams escort-dating "
    "nude-pics erotic-chat hookup-tonight warez-crack keygen-serials torrent-movies cracked-apps payday-loans quick-cash-loan bitcoin-doubler "
    "get-rich-fast earn-money-home replica-watches fake-rolex counterfeit-bags backlinks-buy link-exchange seo-ranker article-spinner "
    "popunder-network banner-exchange pixel-beacon affiliate-redirect clickbait-viral phishing-login malware-drop"
).split()
TO_ALLOW = (
    "city-library national-museum local-history botanical-garden opera-theatre weather-service popular-science home-cooking daily-gazette "
    "encyclopedia town-hall state-university physics-society apple-orchard mountain-rescue river-authority railway-station school-district "
    "public-health court-records parliament philharmonic newspaper-archive journal-medicine dictionary grammar-guide geography chemistry-lab "
    "mathematics architecture hospital-trust football-club chess-federation bicycle-hiking recipes-bakery bookshop-corner art-gallery film-festival "
    "observatory language-school gardening-tips open-source documentation programming-notes statistics-office fire-brigade parish-church poetry"
).split()
SUBDOMAINS = ("", "www.", "m.", "blog.")
SUFFIXES = ("test", "example", "invalid")
LABELLED_PATHS = ["/en/12", "/en/369#top", "/fr/8", "/de/41.html", "/es/670/", "/en/7?page=2", "/", "/en/4817.html"]

#: (url, 1 to block).
LABELLED = [(f"https://{before}{name}.{SUFFIXES[(i + k) % len(SUFFIXES)]}{LABELLED_PATHS[(i + k) % len(LABELLED_PATHS)]}", label) for label, names in ((1, TO_BLOCK), (0, TO_ALLOW)) for i, name in enumerate(names) for k, before in enumerate(SUBDOMAINS)]

#: Share of urls to allow that may be blocked, by estimate on names that a fit has not seen, and folds of the estimate.
MOST_LOST, FOLDS = 0.1, 10
#: Urls that are scored together.
ROWS = 1024
#: Labelled rows that a fit takes at most.
MOST_LABELLED = 10_000
#: Weights of the host and of the path n-grams each, n-gram lengths, descent steps, step size and L2 penalty.
WIDTH, LENGTHS, STEPS, RATE, PENALTY = 1 << 14, (3, 4, 5), 400, 1.0, 1e-3


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest rule that fits, else nulls.

    A rule fits its host and all subdomains where the path starts with the rule's; of equally long
    ones the first in the list wins.
    """
    name = verdict = None
    for own, prefix, what in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        name = F.when(fits, own + prefix) if name is None else name.when(fits, own + prefix)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name.otherwise(None), verdict.otherwise(None)


def ngrams(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of the distinct hashed n-grams: a host's (with its ends marked) below WIDTH, a path's, whose digits count as one, above.

    All n-grams of a batch are hashed together: an n-gram's hash is a polynomial of its bytes, mixed.
    """
    found = []
    for shift, parts in ((0, [f"^{h}$" for h in hosts]), (WIDTH, [f"^{re.sub('[0-9]', '0', p)}$" for p in paths])):
        data = [p.encode("utf-8", "surrogatepass") for p in parts]
        raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
        row = np.repeat(np.arange(len(data)), [len(d) for d in data])
        for n in LENGTHS:
            count = len(raw) - n + 1
            if count <= 0:
                continue
            total = np.zeros(count, np.uint64)
            for k in range(n):
                total = total * np.uint64(257) + raw[k : k + count]
            own = row[:count] == row[n - 1 :]  # none crosses two urls
            slot = mix(total[own] + np.uint64(n << 48)) % np.uint64(WIDTH)
            found.append(row[:count][own] * (2 * WIDTH) + shift + slot.astype(np.int64))
    both = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return both // (2 * WIDTH), both % (2 * WIDTH)


def _parts(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def fit(labelled: list[tuple[str, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias; zero weights and an allowing bias without labelled rows."""
    rows = sorted({(u or "", int(y)) for u, y in labelled if y is not None})
    if not rows:
        return np.zeros(2 * WIDTH), -1.0
    row, slot = ngrams(*zip(*(_parts(u) for u, _ in rows)))
    target = np.array([y for _, y in rows], float)
    share = 1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=len(rows))))  # rows have unit length
    weight = np.where(target == 1, 0.5 / max(1, target.sum()), 0.5 / max(1, (1 - target).sum()))
    w, bias = np.zeros(2 * WIDTH), 0.0
    for _ in range(STEPS):
        z = np.bincount(row, w[slot], len(rows)) * share + bias
        error = (1 / (1 + np.exp(-z)) - target) * weight
        w -= RATE * 10 * (np.bincount(slot, (error * share)[row], 2 * WIDTH) + PENALTY * w)
        bias -= RATE * error.sum()
    return w, float(bias)


def cautious(labelled: list[tuple[str, int]], most_lost: float = MOST_LOST, folds: int = FOLDS) -> tuple[np.ndarray, float]:
    """``fit``, with its bias lowered so that at most a share of ``most_lost`` of the urls to allow would be blocked, judged by fits that have not seen the name.

    A name is what stands before a host's suffix without its subdomains; names are dealt out to folds in sorted order.
    """
    weights, bias = fit(labelled)
    rows = sorted({(u or "", int(y)) for u, y in labelled if y is not None})
    name = lambda u: _parts(u)[0].rsplit(".", 1)[0].rsplit(".", 1)[-1]
    names = {n: k % folds for k, n in enumerate(sorted({name(u) for u, _ in rows}))}
    held = []
    for fold in range(min(folds, len(names))):
        own = [u for u, y in rows if names[name(u)] == fold and not y]
        rest = [(u, y) for u, y in rows if names[name(u)] != fold]
        if own and {y for _, y in rest} == {0, 1}:
            held += scores(fit(rest), *zip(*map(_parts, own))).tolist()
    edge = max(0.0, float(np.quantile(held, 1 - most_lost))) if held else 0.0
    return weights, bias - edge


def scores(model: tuple[np.ndarray, float], hosts: list[str], paths: list[str]) -> np.ndarray:
    """The log-odds that each url is to be blocked."""
    row, slot = ngrams(hosts, paths)
    sums, counts = (np.bincount(row, w, len(hosts)) for w in (model[0][slot], None))
    return sums / np.sqrt(np.maximum(1, counts)) + model[1]


def score(model: tuple[np.ndarray, float], host: str, path: str) -> float:
    """The log-odds of one url."""
    return float(scores(model, [host], [path])[0])


def labelled_rows(labelled: DataFrame, most: int = MOST_LABELLED) -> list[tuple[str, int]]:
    """Up to ``most`` rows (url, label) of a labelled table, smallest hash of the url first."""
    return [
        tuple(r) for r in labelled.select("url", "label").filter("url is not null and label is not null").orderBy(F.xxhash64("url"), "url", "label").limit(most).collect()
    ]


def judge(pages: DataFrame, labelled: DataFrame | list[tuple[str, int]] | None = None, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of each row of ``pages``.

    Null urls and urls without ``://`` have an empty host and path and are judged by the classifier on
    those. Score is the classifier's log-odds, whether or not a rule decides. Repeated rows give a row
    each; further columns are not read.
    """
    rows = labelled_rows(labelled) if isinstance(labelled, DataFrame) else LABELLED if labelled is None else labelled
    model = pages.sparkSession.sparkContext.broadcast(cautious(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                found = scores(own, part.column(1).to_pylist(), part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.float64())],
                    ["page_id", "host", "path", "rule", "fixed", "score"],
                )

    url = pages["url"].cast("string")
    parts = pages.select(pages["page_id"].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, fixed = rule_of(parts["host"], parts["path"], rules)
    schema = T.StructType(
        [T.StructField("page_id", pages.schema["page_id"].dataType)] + [
            T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "fixed")
        ] + [T.StructField("score", T.DoubleType())]
    )
    found = parts.select("page_id", "host", "path", rule.alias("rule"), fixed.alias("fixed")).mapInArrow(run, schema)
    return found.select(
        "page_id", "host", "path", "rule",
        F.coalesce("fixed", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score",
    )

