"""Personal data in DataFrame expressions alone: fixed patterns, and boosted trees for the rest.

Generators propose spans with high recall, overlapping those of the fixed patterns and each other.
Each proposal is described by yes-or-no features of its form and its surroundings. Proposals are
counted by features and by whether a fixed pattern agrees; trees are boosted on these counts (as
many as there are feature patterns, whatever the corpus), a threshold is set on counts kept apart,
and the trees are then one more expression over the proposals.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import keyed_rows, narrow, row_key, with_text, written
from skyledger.llm.quality_rules import _let

KINDS = ("email", "ip", "card", "phone")
MODEL = "model"

#: Fixed patterns. Possessive loops and run starts only avoid retries that cannot succeed: within
#: a run of local or digit characters, a match from a later start exists only if one exists from
#: the first. \G is the end of the match before, where a new run may begin.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text in which this is not found has no valid match.
_NEEDS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9][\x20().0-9-]",
}
#: Proposals: spelled-out or plain addresses, and any spans with seven digits or more.
GENERATORS = {
    "address": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",
    "number": r"\(?[0-9](?:[().\x20-]{0,2}[0-9]){6,18}",
}
_PROPOSES = {"address": r"@|[\[(]at[\])]", "number": r"[0-9](?:[().\x20-]{0,2}[0-9]){6}"}

BEFORE, AFTER = 16, 4
_PART = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"


def _running(sizes: Column) -> Column:
    """Sums of each element and all before it, in as many passes as the length has doublings."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sizes) + F.lit(1))).cast("int"))

    def double(sums: Column, k: Column) -> Column:
        back = F.pow(F.lit(2.0), k).cast("int")
        return F.transform(
            sums, lambda v, i: v + F.when(i >= back, F.get(sums, i - back)).otherwise(F.lit(0))
        )

    return F.aggregate(rounds, sizes, double)


def _matches(text: Column, pattern: str, needs: str) -> Column:
    """array<start, end, s, before, after>: all matches in code points, and what stands around."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def placed(pair: Column) -> Column:
        sizes = F.zip_with(
            pair["found"], pair["between"], lambda m, g: F.length(g) + F.coalesce(F.length(m), F.lit(0))
        )
        return _let(
            _running(sizes),
            lambda ends: F.transform(
                pair["found"],
                lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"),
                    F.get(ends, i).alias("end"),
                    m.alias("s"),
                    F.right(F.get(pair["between"], i), F.lit(BEFORE)).alias("before"),
                    F.left(F.get(pair["between"], i + 1), F.lit(AFTER)).alias("after"),
                ),
            ),
        )

    pair = F.struct(found.alias("found"), between.alias("between"))
    none = F.array().cast("array<struct<start:int,end:int,s:string,before:string,after:string>>")
    return F.when(text.rlike(needs), _let(pair, placed)).otherwise(none)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right doubled, less 9 over 9."""
    places = F.sequence(F.lit(1), F.length(digits))
    values = F.transform(places, lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int"))
    doubled = F.transform(
        values, lambda v, i: F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + v) % 10 == 0


def _ip_parts(s: Column) -> Column:
    return F.forall(F.split(s, r"\."), lambda p: p.rlike(_PART))


_VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda s: F.lit(True),
    "ip": _ip_parts,
    "card": lambda s: F.length(_digits(s)).between(14, 19) & luhn(_digits(s)),
    "phone": lambda s: F.length(_digits(s)).between(10, 15),
}


def _valid(text: Column, number: int, kind: str) -> Column:
    found = F.filter(_matches(text, PATTERNS[kind], _NEEDS[kind]), lambda m: _VALID[kind](m["s"]))
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")),
    )


def _base(text: Column) -> Column:
    """array<start, kind number, end> of the fixed patterns' valid matches, by start and kind."""
    return F.sort_array(F.concat(*(_valid(text, n, kind) for n, kind in enumerate(KINDS))))


#: Features of a proposal, by name.
FEATURES: dict[str, Callable[[Column], Column]] = {
    "at_sign": lambda m: m["s"].contains("@"),
    "dotted_domain": lambda m: m["s"].rlike(r"[A-Za-z0-9]\.[A-Za-z]{2,}$"),
    "ten_digits": lambda m: F.length(_digits(m["s"])) >= 10,
    "fourteen_digits": lambda m: F.length(_digits(m["s"])) >= 14,
    "luhn": lambda m: F.when(F.length(_digits(m["s"])) >= 14, luhn(_digits(m["s"]))).otherwise(False),
    "bracket": lambda m: m["s"].contains("("),
    "hyphen": lambda m: m["s"].contains("-"),
    "four_parts": lambda m: m["s"].rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"),
    "after_plus": lambda m: m["before"].rlike(r"\+$"),
    "in_word": lambda m: m["before"].rlike(r"[A-Za-z0-9_]$") | m["after"].rlike(r"^[A-Za-z0-9_]"),
    "named": lambda m: m["before"].rlike(r"(?i)(?:tel|phone|call|mail|card|contact|addr|ip)[a-z]*[\x20:.=]{0,3}$"),
    "plain": lambda m: m["s"].rlike(r"^[0-9]+$"),
}


def _proposals(text: Column) -> Column:
    """array<start, end, code>: all proposals, their features as bits of the code."""
    each = []
    for name, pattern in GENERATORS.items():
        found = _matches(text, pattern, _PROPOSES[name])
        each.append(
            F.transform(
                found,
                lambda m: F.struct(
                    m["start"].alias("start"),
                    m["end"].alias("end"),
                    sum(
                        (F.when(f(m), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(FEATURES.values())),
                        F.lit(0),
                    ).alias("code"),
                ),
            )
        )
    return F.concat(*each)


class Boosted:
    """Trees of depth three on the logistic loss, from counts of feature patterns."""

    def __init__(self, codes: np.ndarray, good: np.ndarray, bad: np.ndarray, rounds: int = 20) -> None:
        self.trees: list[tuple] = []
        self.bits = codes[:, None] >> np.arange(len(FEATURES)) & 1
        self.start = float(np.log((good.sum() + 1) / (bad.sum() + 1)))
        margin = np.full(len(codes), self.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            slope, curve = good - (good + bad) * p, (good + bad) * p * (1 - p)
            tree = self._grow(np.arange(len(codes)), slope, curve, 3)
            self.trees.append(tree)
            margin += np.array([self._leaf(tree, int(c)) for c in codes])

    def _grow(self, rows: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int) -> tuple:
        worth = lambda m: slope[m].sum() ** 2 / (curve[m].sum() + 1.0)
        best, chosen = 1e-6, None
        for feature in range(len(FEATURES)) if depth else ():
            on = self.bits[rows, feature] == 1
            if on.any() and not on.all():
                gain = worth(rows[on]) + worth(rows[~on]) - worth(rows)
                if gain > best:
                    best, chosen = gain, (feature, on)
        if chosen is None:
            return (float(0.5 * slope[rows].sum() / (curve[rows].sum() + 1.0)),)
        feature, on = chosen
        return feature, self._grow(rows[on], slope, curve, depth - 1), self._grow(rows[~on], slope, curve, depth - 1)

    def _leaf(self, tree: tuple, code: int) -> float:
        while len(tree) > 1:
            tree = tree[1] if code >> tree[0] & 1 else tree[2]
        return tree[0]

    def margin(self, code: int) -> float:
        return self.start + sum(self._leaf(t, code) for t in self.trees)

    def column(self, code: Column) -> Column:
        """The margin as an expression."""

        def of(tree: tuple) -> Column:
            if len(tree) == 1:
                return F.lit(tree[0])
            return F.when(code.bitwiseAND(F.lit(1 << tree[0])) != 0, of(tree[1])).otherwise(of(tree[2]))

        return sum((of(t) for t in self.trees), F.lit(self.start))

    def threshold(self, counts: dict[int, tuple[int, int]], precision: float) -> float | None:
        """The lowest margin from which on enough of the counted proposals are good."""
        good = bad = 0
        lowest = None
        for margin, code in sorted(((self.margin(c), c) for c in counts), reverse=True):
            good, bad = good + counts[code][0], bad + counts[code][1]
            if good >= precision * (good + bad):
                lowest = margin
        return lowest


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def undisputed(scored: Column) -> Column:
    """Of scored spans the best, then each next best that overlaps none of those taken before it."""
    order = lambda c: F.struct(c["score"], c["size"], c["early"])
    better = lambda c, d: F.when(order(c) > order(d), -1).when(order(c) < order(d), 1).otherwise(0)
    ranked = F.array_sort(scored, better)
    return F.aggregate(
        ranked,
        F.slice(ranked, 1, 0),
        lambda taken, c: F.when(F.exists(taken, lambda t: _overlap(t, c)), taken).otherwise(F.array_append(taken, c)),
    )


def pii_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = 0.95
) -> DataFrame:
    """``doc_id, row_key, spans`` for every row.

    ``spans`` are (start, end, kind) in code points, end exclusive, by start and then kind: email,
    ip, card, phone, and ``model`` for proposals that overlap none of these and that the trees
    select, of overlapping ones the best. The threshold is the lowest at which ``precision`` of
    the proposals kept apart agree with a fixed pattern. Without proposals of both kinds, only
    fixed spans remain. Null and empty texts have no spans; null ids and repeated rows are
    scanned like any other; other columns are ignored.
    """
    rows = narrow(docs, id_col, text_col).select(
        "doc_id", row_key().alias("row_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    text = F.col("text")
    scanned = rows.select(
        "doc_id", "row_key", F.inline(F.array(F.struct(_base(text).alias("base"), _proposals(text).alias("seen"))))
    )
    scanned = written(scanned, "proposals")
    marked = scanned.withColumn(
        "seen",
        F.transform(
            "seen",
            lambda c: F.struct(
                c["start"].alias("start"),
                c["end"].alias("end"),
                c["code"].alias("code"),
                F.exists("base", lambda b: _overlap(b, c)).alias("good"),
            ),
        ),
    )
    apart = (F.pmod("row_key", F.lit(4)) == 0).alias("apart")
    counted = marked.select(apart, F.explode("seen").alias("c")).groupBy("apart", "c.code", "c.good").count()
    counts: dict[bool, dict[int, list[int]]] = {True: {}, False: {}}
    for aside, code, good, n in counted.collect():  # at most four numbers per feature pattern
        counts[aside].setdefault(code, [0, 0])[0 if good else 1] += n
    kind = F.transform(
        "base",
        lambda b: F.struct(
            b["start"].alias("start"),
            b["end"].alias("end"),
            F.element_at(F.array(*map(F.lit, KINDS)), b["kind"] + 1).alias("kind"),
        ),
    )
    fitted = _fit(counts[False], counts[True] or counts[False], precision)
    if fitted is None:
        return scanned.select("doc_id", "row_key", kind.alias("spans"))
    trees, threshold = fitted
    scored = F.transform(
        F.filter("seen", lambda c: ~c["good"]),
        lambda c: F.struct(
            trees.column(c["code"]).alias("score"),
            (c["end"] - c["start"]).alias("size"),
            (-c["start"]).alias("early"),
            c["start"].alias("start"),
            c["end"].alias("end"),
        ),
    )
    likely = F.filter(scored, lambda c: c["score"] >= threshold - 1e-9)
    added = F.transform(
        _let(likely, undisputed),
        lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), c["end"].alias("end")),
    )
    names = F.array(*map(F.lit, (*KINDS, MODEL)))
    return marked.select(
        "doc_id",
        "row_key",
        F.transform(
            F.sort_array(F.concat("base", F.array_distinct(added))),
            lambda b: F.struct(
                b["start"].alias("start"), b["end"].alias("end"), F.element_at(names, b["kind"] + 1).alias("kind")
            ),
        ).alias("spans"),
    )


def _fit(
    counts: dict[int, list[int]], aside: dict[int, list[int]], precision: float
) -> tuple[Boosted, float] | None:
    codes = np.array(sorted(counts), np.int64)
    good, bad = (np.array([counts[c][i] for c in codes.tolist()], np.float64) for i in (0, 1))
    if not good.sum() or not bad.sum():
        return None
    trees = Boosted(codes, good, bad)
    threshold = trees.threshold({c: (g, b) for c, (g, b) in aside.items()}, precision)
    return None if threshold is None else (trees, threshold)


def redact_pii(docs: DataFrame, precision: float = 0.95, mark: str = "[PII]") -> DataFrame:
    """All rows and columns of ``docs``, each stretch of personal data in ``text`` replaced.

    ``n_chars``, if there, follows a text that changed. Null and empty texts stay as they are, and rows
    that are equal in id and text change alike.
    """
    found = pii_spans(docs, precision=precision).filter(F.size("spans") > 0)
    found = found.select("row_key", "spans").dropDuplicates(["row_key"])
    joined = keyed_rows(docs).join(found, "row_key", "left")
    text = F.col("row.text")

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    clean = F.aggregate(
        "spans", begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    return with_text(joined, docs.columns, clean, F.col("spans").isNotNull())
