"""Mixing sources to target weights with soft domain membership.

A table of labelled documents teaches a naive Bayes classifier over a few
binned features of the text, among them whether words that mark a domain occur.
Every document gets a posterior over the domains, and expected tokens of each.
Document rates r >= 0 are fitted so that the expected tokens of every domain
meet its target: projected gradient steps on the weighted least squares

    1/2 (A r - t)' W (A r - t),   A[k, d] = tokens of d * posterior of k,   W = (A diag(1/tokens) A')^-1

in the metric that counts a document by its tokens; the tokens and posteriors in
W are those of documents whose rate can still fall. There a step of 1 is the
last one if no further rate reaches zero. A step needs a few sums over all
documents, which tasks take in parts. Documents of equal
posterior have equal rates, so the steps run over sums per posterior, of which
there are as many as combinations of bins at most. Nothing leaves the JVM but
counts per combination and sums per domain.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.workspace import new_dir

# Expected size of the sample of labelled texts that marker words are learned from, and markers per domain.
LABELLED = 8_000
MARKERS = 16
MARKER_LETTERS = 5
MIN_LIFT = 4.0
STEPS = 60
# Steps without a smaller gap after which the best so far is the answer.
PATIENCE = 12
TOLERANCE = 1e-6

UPPER = "A-Z"
SIGNS = "#*$%&|<>!"


@dataclass(frozen=True)
class Model:
    domains: tuple[str, ...]
    patterns: tuple[str, ...]
    # log P(domain) and, per feature, log P(bin | domain)
    prior: tuple[float, ...]
    bins: dict[str, tuple[tuple[float, ...], ...]]


def _cut(value: Column, bars: tuple[float, ...]) -> Column:
    """Number of bars that the value reaches."""
    out = F.lit(0)
    for bar in bars:
        out = out + (value >= bar).cast("int")
    return out


# Feature -> number of bins, without the markers, which have two each.
BINS = {"upper": 3, "signs": 4, "repeats": 4, "length": 3}


def features(text: Column, patterns: tuple[str, ...]) -> dict[str, Column]:
    """Expressions without lambdas, so that Spark splits a text once for all that ask for its words."""
    words = F.split(text, r"[\x20\x09-\x0D]+", -1)
    chars = F.greatest(F.length(text), F.lit(1))
    count = F.size(words)
    # One pass over the text leaves both kinds, which are few.
    kept = F.regexp_replace(text, f"[^{UPPER}{SIGNS}]+", "")
    signs = F.length(F.regexp_replace(kept, f"[{UPPER}]+", ""))
    return {
        "tokens": F.size(F.array_remove(words, "")).cast("long"),
        "upper": _cut((F.length(kept) - signs) / chars, (0.1, 0.4)),
        "signs": _cut(signs / chars, (0.001, 0.01, 0.06)),
        "repeats": _cut(F.size(F.array_distinct(words)) / count, (0.1, 0.3, 0.5)),
        "length": _cut(count.cast("double"), (12.0, 60.0)),
        **{f"marker_{i}": F.coalesce(text.rlike(p), F.lit(False)).cast("int") if p else F.lit(0) for i, p in enumerate(patterns)},
    }


def _patterns(texts: DataFrame, domains: tuple[str, ...]) -> tuple[str, ...]:
    """Per domain a pattern of the beginnings of words that are far more common in it; empty if there are none."""
    first = F.transform(
        F.split(F.lower("text"), r"[^\p{L}]+", -1), lambda w: F.substring(w, 1, MARKER_LETTERS)
    )
    held = texts.select("domain", F.array_distinct(F.filter(first, lambda w: F.length(w) >= 3)).alias("words"))
    sizes = {r.domain: r.n for r in held.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    counts = [F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(domains)]
    words = held.select("domain", F.explode("words").alias("word")).groupBy("word").agg(*counts)
    patterns = []
    for i, domain in enumerate(domains):
        size, rest = sizes.get(domain, 0), sum(sizes.values()) - sizes.get(domain, 0)
        others = sum((F.col(f"n{j}") for j in range(len(domains)) if j != i), F.lit(0))
        lift = (F.col(f"n{i}") / F.lit(max(size, 1))) / ((others + 1) / F.lit(max(rest, 1)))
        marks = words.filter((F.col(f"n{i}") >= F.greatest(F.lit(3), F.lit(0.01 * size))) & (lift >= MIN_LIFT))
        best = [r.word for r in marks.orderBy(lift.desc(), "word").select("word").limit(MARKERS).collect()]
        patterns.append(rf"(?iu)(?<!\p{{L}})(?:{'|'.join(sorted(best))})" if best else "")
    return tuple(patterns)


def fit(
    df: DataFrame,
    labelled: DataFrame,
    domains: tuple[str, ...],
    key_col: str = "doc_id",
    text_col: str = "text",
    whole: bool = False,
) -> tuple[Model, DataFrame]:
    """A model from rows of ``df`` that ``labelled`` (key, domain) knows, and the binned features of all rows.

    Features are computed once and written, with ``whole`` beside the row they belong to (``row``). Rows without a null in key and domain teach; a key labelled twice counts by
    its least domain. A domain that no such row has is given no posterior; without any such row all posteriors are equal.
    """
    spark = df.sparkSession
    known = labelled.select(F.col(f"`{key_col}`").alias("key"), "domain").filter("key is not null")
    known = known.filter(F.col("domain").isin(*domains)).groupBy("key").agg(F.min("domain").alias("domain"))
    total = known.count()
    part = F.pmod(F.xxhash64("key", F.lit(29)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, LABELLED / max(total, 1)))
    own = df.select(
        F.col(f"`{key_col}`").alias("key"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
    )
    texts = own.select("key", "text").filter(part).join(known.filter(part), "key")
    sample = new_dir(spark, "labelled")
    texts.write.parquet(sample)
    patterns = _patterns(spark.read.parquet(sample), domains)
    described = features(F.col("text"), patterns)
    path = new_dir(spark, "features")
    kept = ["key", "row"] if whole else ["key"]
    own.select(*kept, *[c.alias(n) for n, c in described.items()]).write.parquet(path)
    rows = spark.read.parquet(path)
    names = [n for n in described if n != "tokens"]
    cells = rows.filter("key is not null").join(known, "key").groupBy("domain", *names).agg(F.count("*").alias("n")).collect()
    size = {d: sum(c.n for c in cells if c.domain == d) for d in domains}
    taught = any(size.values())
    prior = tuple(math.log((size[d] + 1) / (sum(size.values()) + len(domains))) if size[d] or not taught else -math.inf for d in domains)
    bins = {}
    for name in names:
        width = BINS.get(name, 2)
        bins[name] = tuple(
            tuple(math.log((sum(c.n for c in cells if c.domain == d and c[name] == b) + 0.5) / (size[d] + 0.5 * width)) for b in range(width))
            for d in domains
        )
    return Model(domains, patterns, prior, bins), rows


def posteriors(model: Model) -> Column:
    """Array of the domains' probabilities, in four decimals, from the binned features of a row."""
    logs = []
    for k in range(len(model.domains)):
        total = F.lit(model.prior[k])
        for name, per_domain in model.bins.items():
            total = total + F.get(F.array(*[F.lit(x) for x in per_domain[k]]), F.col(name))
        logs.append(total)
    all_ = F.array(*logs)
    raised = F.transform(all_, lambda x: F.exp(x - F.array_max(all_)))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return F.transform(raised, lambda x: F.round(x / total(raised), 4))


def _inverse(matrix: list[list[float]]) -> list[list[float]]:
    n = len(matrix)
    rows = [[*r, *[float(i == j) for j in range(n)]] for i, r in enumerate(matrix)]
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


def _rate(steps: list[list[float]], p: Column, lowest: float) -> Column:
    """The rate after all steps, from 1 on: r <- max(lowest, r - p . step)."""
    if not steps:
        return F.lit(1.0)
    given = F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps])
    dot = lambda a: F.aggregate(F.zip_with(a, p, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(given, F.lit(1.0), lambda r, step: F.greatest(F.lit(lowest), r - dot(step)))


def solve(cells: DataFrame, weights: Mapping[int, float], domains: int, keep_all: bool) -> tuple[list[list[float]], list[float], list[float]]:
    """The steps of the fit over cells (p, tokens), the targets, and the totals that are reached."""
    at = lambda k: F.get("p", F.lit(k))

    def measured(rate: Column) -> tuple[list[float], list[list[float]]]:
        """Totals per domain at a rate, and the products of posteriors of what can still shrink."""
        free = F.when(rate > lowest, F.col("tokens")).otherwise(0.0)
        sums = [F.sum(free * at(i) * at(j)).alias(f"g{i}_{j}") for i in range(domains) for j in range(domains)]
        row = cells.agg(*sums, *[F.sum(F.col("tokens") * rate * at(k)).alias(f"s{k}") for k in range(domains)]).first()
        gram = [[float(row[f"g{i}_{j}"] or 0.0) for j in range(domains)] for i in range(domains)]
        return [float(row[f"s{k}"] or 0.0) for k in range(domains)], gram

    lowest = float(keep_all)
    have, gram = measured(F.lit(lowest + 1))
    have = [x / (lowest + 1) for x in have]
    total = sum(have)
    live = [k for k in range(domains) if weights.get(k, 0) > 0 and have[k] > 0]
    share = sum(weights[k] for k in live)
    targets = [weights[k] / share * total if k in live else 0.0 for k in range(domains)]
    if keep_all and live:
        grow = max(1.0, *[have[k] / targets[k] for k in live])
        targets = [t * grow for t in targets]
    if not live:
        return [], targets, have
    ridge = 1e-6 * max(gram[i][i] for i in range(domains))
    steps: list[list[float]] = []
    reached, best = have, (math.inf, 0, have)
    for _ in range(STEPS):
        gap = [a - t for a, t in zip(reached, targets)]
        size = max(map(abs, gap))
        if size < best[0]:
            best = (size, len(steps), reached)
        if size <= TOLERANCE * max(total, 1) or len(steps) - best[1] >= PATIENCE:
            break
        inverse = _inverse([[x + ridge * (i == j) for j, x in enumerate(r)] for i, r in enumerate(gram)])
        steps.append([sum(inverse[i][j] * gap[j] for j in range(domains)) for i in range(domains)])
        reached, gram = measured(_rate(steps, F.col("p"), lowest))
    return steps[: best[1]], targets, best[2]


@dataclass(frozen=True)
class Mix:
    """The fit; ``targets`` and ``reached`` are expected tokens of each domain, which differ where no rates meet the targets."""

    model: Model
    steps: list[list[float]]
    lowest: float
    targets: list[float]
    reached: list[float]


def mix(
    df: DataFrame,
    labelled: DataFrame,
    weights: Mapping[str, float],
    key_col: str = "doc_id",
    text_col: str = "text",
    keep_all: bool = False,
    whole: bool = False,
) -> tuple[Mix, DataFrame]:
    """The fitted rates as a function of a row's features, and the features of all rows (key first, then with ``whole`` the row).

    ``weights`` are the shares of tokens that the domains are to have. The tokens of all are kept, or with ``keep_all``
    multiplied until no domain has to shrink, and no rate is below 1. A domain of weight 0 or without expected tokens, such
    as one without labelled documents, is left out and the others share its weight. Null texts are empty and have no tokens; their rate follows from their
    posterior like any other.
    """
    domains = tuple(weights)
    model, rows = fit(df, labelled, domains, key_col, text_col, whole)
    cells = rows.groupBy(*model.bins).agg(F.sum("tokens").cast("double").alias("tokens")).select(posteriors(model).alias("p"), "tokens")
    path = new_dir(df.sparkSession, "cells")
    cells.write.parquet(path)
    steps, targets, reached = solve(df.sparkSession.read.parquet(path), {k: weights[d] for k, d in enumerate(domains)}, len(domains), keep_all)
    return Mix(model, steps, float(keep_all), targets, reached), rows


def _told(found: Mix, rows: DataFrame) -> DataFrame:
    return rows.withColumn("p", posteriors(found.model)).withColumn("rate", _rate(found.steps, F.col("p"), found.lowest))


def rates(
    df: DataFrame,
    labelled: DataFrame,
    weights: Mapping[str, float],
    key_col: str = "doc_id",
    text_col: str = "text",
    with_totals: bool = False,
) -> DataFrame:
    """One row per row: key, n_tokens, a posterior ``p_<domain>`` per domain, and ``rate``; see ``mix``.

    ``with_totals`` adds, the same in all rows, ``target_<domain>`` and ``reached_<domain>``, the tokens that the domain was to
    have and the expected tokens that it has at these rates.
    """
    found, rows = mix(df, labelled, weights, key_col, text_col)
    shares = [F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(found.model.domains)]
    totals = _totals(found) if with_totals else []
    return _told(found, rows).select(F.col("key").alias(key_col), F.col("tokens").alias("n_tokens"), *shares, "rate", *totals)


def _totals(found: Mix) -> list[Column]:
    return [
        F.lit(float(x)).alias(f"{name}_{d}")
        for name, of in (("target", found.targets), ("reached", found.reached))
        for d, x in zip(found.model.domains, of)
    ]


def _counted(df: DataFrame, labelled: DataFrame, weights: Mapping[str, float], key_col: str, text_col: str, keep_all: bool) -> tuple[Mix, DataFrame]:
    """The fit, and per row of ``df`` the row and its number of copies, from the features that the fit has written."""
    found, rows = mix(df, labelled, weights, key_col, text_col, keep_all, whole=True)
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    times = copies(F.col("rate"), F.col("key"), text)
    return found, _told(found, rows).select("row", (F.greatest(times, F.lit(1)) if keep_all else times).alias("times"))


def counted(df: DataFrame, labelled: DataFrame, weights: Mapping[str, float], key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``df``, each once, with ``copies``, ``target_<domain>`` and ``reached_<domain>`` (columns of these names are replaced).

    ``copies`` is how often the row is to be taken, 0 or more, with its rate as the mean, so that the tokens of all copies are about
    as many as before and those of the domains come near their targets. It is drawn by a hash of key and text: equal rows
    have equal numbers. Null texts are empty; their number follows from their posterior.
    """
    found, rows = _counted(df, labelled, weights, key_col, text_col, keep_all=False)
    totals = _totals(found)
    added = ["copies", *[f"{name}_{d}" for name in ("target", "reached") for d in weights]]
    own = [F.col("row").getField(c).alias(c) for c in df.columns if c not in added]
    return rows.select(*own, F.col("times").alias("copies"), *totals)


def repeated(df: DataFrame, labelled: DataFrame, weights: Mapping[str, float], key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``df``, each as often as its rate says and at least once; columns stay as they are."""
    _, rows = _counted(df, labelled, weights, key_col, text_col, keep_all=True)
    again = rows.select("row", F.explode(F.sequence(F.lit(1), "times")).alias("time"))
    return again.select(*[F.col("row").getField(c).alias(c) for c in df.columns])


def copies(rate: Column, *key: Column) -> Column:
    """A whole number of copies with the rate as its mean, by a hash of the key."""
    even = F.pmod(F.xxhash64(*key, F.lit(41)), F.lit(1_000_000)) / 1_000_000
    return F.floor(rate + even).cast("int")
