"""Personal data: candidate spans, boosted trees over their format and context, calibrated thresholds.

Generators propose spans with high recall: four strict patterns (whose matches
that pass their own check are always reported) and one or two looser ones per
kind. A loose candidate is described by small integer features of its format and
of the text around it. There are no labels for personal data, so the checks
supply them:

* A checked strict span is rewritten to the loose forms of its kind (its at sign
  and dots spelled, its plus dropped) and is a positive where it stands.
* A loose candidate that fails the check of its kind is negative. One that passes
  is positive for cards (Luhn) and addresses of hosts (four octets). The check of
  mail and phones says little, so there one without any sign in its form or
  context is negative, and one with a sign has no label.
* Candidates that touch a checked span can never be added and do not count.

So the trees learn how personal data looks and where it stands, from examples
that look like what may be added.

Trees only see the features, so the number of candidates and positives per
combination of features is all that fitting needs: one aggregation over all
documents, whose result is bounded by the number of combinations. The fitted
trees are column expressions. Nothing leaves the JVM on the way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.spans import apart, digits, listed, matches, of_kind, overlaps, passes_luhn

# The strict patterns. Where a group would be tried again from each
# of its characters, a look-behind or a possessive count says so; the matches are
# the same and very long words cost linear time.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Looser forms. Their kind is that of the strict pattern they resemble.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]{2,63}(?:\x20?(?:[\[(]\x20?(?:dot|DOT)\x20?[\])]|\.)\x20?[A-Za-z0-9-]{2,63})++",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])(?![0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9])[0-9]{1,3}(?:(?:\x20?[\[(]\x20?(?:\.|dot|DOT)\x20?[\])]\x20?|\x20(?:dot|DOT)\x20|\.)[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20.-][0-9]{2,4}){2,4}(?![0-9A-Za-z])",
}
NUMBER = r"(?<![0-9A-Za-z+.-])[0-9]{9,19}(?![0-9A-Za-z])"
WORDS = {
    "email": "mail|contact|write to|reach",
    "ip": r"\bip\b|host|server|addr",
    "card": "card|visa|credit|debit|payment|konto|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|cell|ruf|appel|llam",
}

# name -> number of values; their product bounds the table that fitting collects.
FEATURES = {
    "kind": 4,
    "checked": 2,
    "count": 6,
    "groups": 4,
    "bracket": 2,
    "spelled": 2,
    "word": 2,
    "before": 4,
    "after": 4,
}
SIDE = 32


@dataclass(frozen=True)
class Split:
    feature: str
    at: int
    low: "Split | float"
    high: "Split | float"


@dataclass(frozen=True)
class Model:
    trees: tuple[Split | float, ...]
    thresholds: dict[str, float]
    base_score: float


def _side(character: Column) -> Column:
    """0 border or white space, 1 punctuation, 2 letter, 3 digit."""
    return (
        F.when((character == "") | character.rlike(r"^\s"), 0)
        .when(character.rlike("^[0-9]"), 3)
        .when(character.rlike(r"^\p{L}"), 2)
        .otherwise(1)
    )


def _described(text: Column, span: Column, kind: str) -> Column:
    """A candidate in a loose form with its features."""
    hit, start, end = span["hit"], span["start"], span["end"]
    count = F.length(digits(hit))
    left = F.lower(F.substring(text, F.greatest(start - SIDE + 1, F.lit(1)), F.least(start, F.lit(SIDE))))
    groups = F.size(F.split(hit, r"[^0-9A-Za-z]+"))
    return F.struct(
        start.alias("start"),
        end.alias("end"),
        F.lit(kind).alias("kind"),
        F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            _loose_passes(kind, hit).cast("int").alias("checked"),
            F.when(count < 4, 0).when(count < 9, 1).when(count < 10, 2).when(count < 12, 3).when(count < 16, 4).otherwise(5).alias("count"),
            (F.least(F.greatest(groups, F.lit(1)), F.lit(4)) - 1).alias("groups"),
            F.instr(hit, "(").cast("boolean").cast("int").alias("bracket"),
            hit.rlike("dot|DOT").cast("int").alias("spelled"),
            left.rlike(WORDS[kind]).cast("int").alias("word"),
            _side(F.substring(text, start, F.when(start > 0, 1).otherwise(0))).alias("before"),
            _side(F.substring(text, end + 1, F.lit(1))).alias("after"),
        ).alias("f"),
    )


def _passes(kind: str, hit: Column) -> Column:
    count = F.length(digits(hit))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return count.between(12, 19) & passes_luhn(digits(hit))
    return count.between(9, 15)


def _loose_passes(kind: str, hit: Column) -> Column:
    """The check of a kind, as far as a loose form can satisfy it."""
    if kind == "ip":
        return _passes(kind, F.regexp_replace(hit, "[^0-9]+", "."))
    if kind == "phone":
        return F.length(digits(hit)).between(7, 15)
    return _passes(kind, hit)


def _rewritten(kind: str, hit: Column) -> list[Column]:
    """A strict match in the loose forms of its kind; what a loose pattern would not find as a whole is no example."""
    if kind == "email":
        name, domain = F.substring_index(hit, "@", 1), F.substring_index(hit, "@", -1)
        spelled = [F.concat(name, F.lit(f" {a}at{b} "), F.replace(domain, F.lit("."), F.lit(dot))) for a, b, dot in (("[", "]", " [dot] "), ("(", ")", " (dot) "))]
        return [*spelled, *[F.concat(name, F.lit(at), domain) for at in (" [at] ", " (at) ")]]
    if kind == "ip":
        return [F.replace(hit, F.lit("."), F.lit(dot)) for dot in ("[.]", "(.)", "[dot]", " dot ")]
    if kind == "card":
        return [F.regexp_replace(digits(hit), "([0-9]{4})(?=[0-9])", "$1.")]
    return [F.regexp_replace(hit, r"^\+[0-9]{1,3}[\x20.-]+", ""), digits(hit)]


def _whole(kind: str) -> str:
    return "^(?:" + "|".join([LOOSE[kind], *([NUMBER] if kind == "phone" else [])]) + ")$"


def with_candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``pii_base`` (the checked strict spans) and ``pii_candidates`` (the loose ones that touch none of them, described)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    numbers = text.rlike("[0-9]")
    worth = {"email": F.contains(text, F.lit("@")), "ip": numbers, "card": numbers, "phone": F.contains(text, F.lit("+"))}
    strict = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    raw = df.select("*", *[matches(text, strict[k], worth[k]).alias(f"_raw_{k}") for k in KINDS])

    def kept(kind: str) -> Column:
        found = F.filter(F.col(f"_raw_{kind}"), lambda s: _passes(kind, s["hit"]))
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    based = raw.withColumn("pii_base", F.concat(*[kept(k) for k in KINDS])).drop(*[f"_raw_{k}" for k in KINDS])
    bracket = F.contains(text, F.lit("(")) | F.contains(text, F.lit("["))
    spelled = F.contains(text, F.lit(" dot ")) | F.contains(text, F.lit(" DOT "))
    worth = {"email": bracket, "ip": numbers & (bracket | spelled), "card": numbers, "phone": numbers}
    proposals = []
    for kind, pattern in (*LOOSE.items(), ("phone", NUMBER)):
        free = F.filter(matches(text, pattern, worth[kind]), lambda c: ~F.exists(F.col("pii_base"), lambda b: overlaps(b, c)))
        proposals.append(F.transform(free, lambda c: _described(text, c, kind)))
    return based.withColumn("pii_candidates", F.concat(*proposals))


def _examples(text: Column) -> Column:
    """Features and label ``y`` of all that trees learn from in a text."""
    parts = []
    for kind in KINDS:
        own = F.filter("pii_base", lambda b: b["kind"] == kind)
        hit = lambda b: F.substring(text, b["start"] + 1, b["end"] - b["start"])
        for form in range(len(_rewritten(kind, F.lit("")))):
            spans = F.transform(own, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), _rewritten(kind, hit(b))[form].alias("hit")))
            fits = F.filter(spans, lambda x: x["hit"].rlike(_whole(kind)))
            parts.append(F.transform(fits, lambda x: F.struct(_described(text, x, kind)["f"].alias("f"), F.lit(True).alias("y"))))

    def label(c: Column) -> Column:
        f = c["f"]
        sign = (f["word"] == 1) | F.when(c["kind"] == "email", f["spelled"] == 1).otherwise(f["bracket"] == 1)
        return F.when(f["checked"] == 0, False).when(c["kind"].isin("card", "ip"), True).when(~sign, False)

    found = F.transform("pii_candidates", lambda c: F.struct(c["f"].alias("f"), label(c).alias("y")))
    return F.concat(*parts, F.filter(found, lambda x: x["y"].isNotNull()))


def fit(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", rounds: int = 24, rate: float = 0.3, precision: float = 0.98) -> Model:
    """Trees and thresholds from all documents.

    One fifth of them (by a hash of key and text) only calibrates: the threshold of
    a kind is the lowest score from which on, at every score, at least ``precision``
    of its held-out examples that pass its check are positive, and of all of them less
    two standard errors. A kind
    without enough evidence (about 40 held-out positives) gets a threshold that
    nothing reaches, so that nothing is added.
    """
    seen = with_candidates(df, text_col).select(
        (F.pmod(F.xxhash64(F.col(f"`{key_col}`"), F.col(f"`{text_col}`")), F.lit(5)) == 0).alias("held"),
        _examples(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("c"),
    )
    rows = (
        # Not the inner form: it lets Spark test the size of all candidates before, by finding them once more.
        seen.select("held", F.explode_outer("c").alias("c"))
        .groupBy("held", *[F.col(f"c.f.{n}").alias(n) for n in FEATURES])
        .agg(F.count("*").alias("n"), F.sum(F.col("c.y").cast("long")).alias("p"))
        .collect()
    )
    order = sorted((r for r in rows if r["kind"] is not None), key=lambda r: tuple(r))
    cells = [[r[n] for n in FEATURES] for r in order]
    fitted = [i for i, r in enumerate(order) if not r.held]
    n = [float(r.n) for r in order]
    p = [float(r.p) for r in order]
    total, positive = sum(n[i] for i in fitted), sum(p[i] for i in fitted)
    start = math.log((positive + 1) / (total - positive + 1))
    scores = [start] * len(order)
    trees: list[Split | float] = []
    for _ in range(rounds if fitted else 0):
        chance = [1 / (1 + math.exp(-s)) for s in scores]
        slope = [p[i] - n[i] * chance[i] for i in range(len(order))]
        curve = [n[i] * chance[i] * (1 - chance[i]) for i in range(len(order))]
        tree = _grown(cells, slope, curve, fitted, 3, rate)
        trees.append(tree)
        scores = [s + _leaf(tree, c) for s, c in zip(scores, cells)]
    thresholds = {}
    for code, kind in enumerate(KINDS):
        held = [i for i, r in enumerate(order) if r.held and r.kind == code and r.checked]
        thresholds[kind] = _threshold([(scores[i], n[i], p[i]) for i in held], precision)
    return Model(tuple(trees), thresholds, start)


def _leaf(tree: Split | float, cell: Sequence[int]) -> float:
    names = list(FEATURES)
    while isinstance(tree, Split):
        tree = tree.low if cell[names.index(tree.feature)] <= tree.at else tree.high
    return tree


def _grown(cells, slope, curve, members, depth: int, rate: float) -> Split | float:
    """The tree of a Newton step, each split by the largest gain; ties to the first feature and value."""
    g, h = sum(slope[i] for i in members), sum(curve[i] for i in members)
    leaf = rate * g / (h + 1)
    if depth == 0:
        return leaf
    best = (1e-6, None, 0)
    for position, (name, values) in enumerate(FEATURES.items()):
        per = [[0.0, 0.0] for _ in range(values)]
        for i in members:
            per[cells[i][position]][0] += slope[i]
            per[cells[i][position]][1] += curve[i]
        low_g = low_h = 0.0
        for at in range(values - 1):
            low_g, low_h = low_g + per[at][0], low_h + per[at][1]
            gain = low_g**2 / (low_h + 1) + (g - low_g) ** 2 / (h - low_h + 1) - g**2 / (h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, name, at)
    if best[1] is None:
        return leaf
    where = list(FEATURES).index(best[1])
    low = [i for i in members if cells[i][where] <= best[2]]
    high = [i for i in members if cells[i][where] > best[2]]
    if not low or not high:
        return leaf
    return Split(best[1], best[2], _grown(cells, slope, curve, low, depth - 1, rate), _grown(cells, slope, curve, high, depth - 1, rate))


def _threshold(scored: list[tuple[float, float, float]], precision: float) -> float:
    lowest, n, p = math.inf, 0.0, 0.0
    for score in sorted({s for s, _, _ in scored}, reverse=True):
        own_n, own_p = (sum(x[i] for x in scored if x[0] == score) for i in (1, 2))
        if own_p < precision * own_n:
            break
        n, p = n + own_n, p + own_p
        share = (p + 1) / (n + 2)
        if share - 2 * math.sqrt(share * (1 - share) / (n + 2)) >= precision - 0.05:
            lowest = score
    return lowest


def _sql(tree: Split | float) -> str:
    """The tree as an expression of a candidate ``c``."""
    if not isinstance(tree, Split):
        return f"{tree!r}D"
    return f"IF(c.f.{tree.feature} <= {tree.at}, {_sql(tree.low)}, {_sql(tree.high)})"


def detect(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``pii_base`` and ``pii_spans`` (the base and what the trees add), arrays of start, end, kind.

    Added spans pass the check of their kind and never touch a base span or each other; the higher score wins, then the
    smaller start.
    Null texts are empty. Rows, repeated ones too, stay one to one; other columns stay, whatever their names, but for
    those called ``pii_base`` and ``pii_spans``, which are replaced. Very long texts and matches are walked through in loops.
    """
    names = [c for c in df.columns if c not in ("pii_base", "pii_spans")]
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = with_candidates(own, "text")
    score = " + ".join([f"{model.base_score!r}D", *map(_sql, model.trees)])
    scored = F.expr(
        "transform(filter(pii_candidates, c -> c.f.checked = 1), "
        f"c -> named_struct('order', -({score}), 'start', c.start, 'end', c.end, 'kind', c.kind))"
    )
    reached = {k: t for k, t in model.thresholds.items() if t < math.inf}

    def passes(c: Column) -> Column:
        fits = F.lit(False)
        for kind, bar in reached.items():
            fits = fits | ((c["kind"] == kind) & (-c["order"] >= bar))
        return fits

    passed = F.filter(scored, passes)
    chosen = found.withColumn("_ranked", F.array_sort(passed))
    added = F.transform(
        apart(F.col("_ranked"), F.col("pii_base")),
        lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")),
    )
    told = chosen.select("row", "pii_base", F.concat("pii_base", added).alias("pii_spans"))
    return told.select(*[F.col("row").getField(c).alias(c) for c in names], "pii_base", "pii_spans")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        fresh = F.struct(
            s["end"].alias("at"),
            F.concat(done["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"),
        )
        joined = F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out"))
        return F.when(s["start"] < done["at"], joined).otherwise(fresh)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(ordered, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def digest(df: DataFrame) -> DataFrame:
    """Counts and digests of detected spans."""
    base = F.col("pii_base")
    counts = [F.size(of_kind(base, k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return df.select(
        "doc_id",
        *counts,
        F.sha2(listed(base, KINDS), 256).alias("base_sha256"),
        listed(F.col("pii_spans"), KINDS).alias("spans"),
        (F.size("pii_spans") - F.size("pii_base")).cast("long").alias("n_added"),
    )
