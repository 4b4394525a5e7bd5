"""Personal data in text: base patterns, and weakly supervised spans beside them. DataFrame functions only.

Method: weak-supervision aggregation. Wider patterns propose candidate spans that no base
span overlaps. Labelers vote on each, for, against or not at all: strict shapes, checksums,
gazetteers of words before the span, and its surroundings. Expectation-maximisation over the
counts of vote patterns (at most 3 to the number of labelers, so a bounded table) estimates
each labeler's reliability and a chance per pattern. A naive Bayes classifier over features
of the span and its context, trained on those chances by counting, takes the decision.

A text may hold very many spans. Running sums and maxima are therefore taken in two levels,
over runs of about the square root of their number, and places are cut out of pieces of the
text, not out of the whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.llm.common import stored

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "mail", "number", "secret", "ssn", "tel")
KINDS = BASE + ADDED
CONTEXT = 24
LEAST_CHANCE = 0.5
SMOOTHING = 10.0
BUCKETS = 1024
PIECE = 1024
SETTLED = 1e-6
FOUND = "array<struct<s:int,e:int,m:string>>"

#: Java patterns that find what the stated ones find. Quantifiers are possessive and runs are entered at their start only
#: (or where the last match ended), so that long runs take linear time and no recursion.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?[\[(]\s?at\s?[\])]\s?[A-Za-z0-9-]++(?:\s?[\[(]\s?dot\s?[\])]\s?|\.)[A-Za-z]{2,}+"
SECRET = r"""(?i)(?:token|secret|passw(?:or)?d|api[_-]?key)["']?\s{0,3}[:=]\s{0,3}["']?[A-Za-z0-9+/_-]{8,}+["']?"""
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
TEL = r"(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"

FOR_WORDS = r"(?i)(?:phone|tel|call|mobile|fax|card|visa|master|amex|ssn|social|iban|account|acct|bank|token|secret|passw|key|mail|contact|reach)[^A-Za-z]{0,6}$"
AGAINST_WORDS = r"(?i)(?:order|invoice|isbn|issn|doi|version|page|figure|fig|table|chapter|no|nr|ref|id|build|section|vol)[^A-Za-z]{0,4}$"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(items: Column, value: Callable[[Column], Column], join: Callable[[Column, Column], Column],
             out: Callable[[Column, Column], Column]) -> Column:
    """`out` of each item and the join of all values before it; `join` is associative, from 0 on.

    The items are taken in runs of the square root of their number, so the arrays that grow
    step by step are short.
    """
    def before(start: Column, values: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast("array<int>").alias("seen"))
        return F.aggregate(values, first, lambda acc, x: F.struct(
            join(acc["at"], x).alias("at"), F.concat(acc["seen"], F.array(acc["at"])).alias("seen")), lambda acc: acc["seen"])

    def whole(xs: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(xs))).cast("int"), F.lit(1))
        runs = _bound(size, lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(xs) / w).cast("int") - 1, F.lit(0))),
                                                  lambda i: F.transform(F.slice(xs, i * w + 1, w), value)))
        starts = lambda rs: before(F.lit(0), F.transform(rs, lambda r: F.aggregate(r, F.lit(0), lambda acc, x: join(acc, x))))
        return _bound(runs, lambda rs: F.zip_with(xs, F.flatten(F.zip_with(starts(rs), rs, before)), out))

    return _bound(items, whole)


def _pieces(text: Column) -> Column:
    """A text in pieces of `PIECE` code points, for `_cut`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points from `start` up to `end` of a text in pieces."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((F.greatest(end, start + 1) - 1) / PIECE).cast("int")
    return F.substring(F.array_join(F.slice(pieces, first + 1, last - first + 1), ""), start - first * PIECE + 1, F.greatest(end - start, F.lit(0)))


def _places(text: Column, pattern: str, when: Column) -> Column:
    """Matches of `pattern`, leftmost and not overlapping, as (start, end, match) in code points; none where `when` fails.

    The texts between matches and the matches themselves add up to the whole text, so their
    lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(found, between, lambda m, g: F.struct(m.alias("m"), F.char_length(g).alias("g"), F.char_length(m).alias("n")))
    placed = _running(F.filter(steps, lambda x: x["m"].isNotNull()), lambda x: x["g"] + x["n"], lambda a, b: a + b,
                      lambda x, at: F.struct((at + x["g"]).alias("s"), (at + x["g"] + x["n"]).alias("e"), x["m"].alias("m")))
    return F.when(when, placed).otherwise(F.from_json(F.lit("[]"), FOUND))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Whether the digits of a match pass Luhn's check."""
    digits = F.reverse(_digits(m))
    total = F.aggregate(
        F.sequence(F.lit(1), F.char_length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(2 * d - 9 * (d > 4)) for d in range(10)]), F.substring(digits, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def _size_between(m: Column, low: int, high: int) -> Column:
    return F.char_length(_digits(m)).between(low, high)


def _small_parts(m: Column) -> Column:
    """Whether all parts of an address are at most 255."""
    def small(p: Column) -> Column:
        short = F.regexp_replace(p, "^0+", "")
        return F.when(F.char_length(short) > 3, False).otherwise(F.concat(F.lit("0"), F.substring(short, 1, 3)).cast("int") <= 255)

    return F.forall(F.split(m, r"\."), small)


def annotate(docs: DataFrame, text_col: str = "text", prefix: str = "__") -> DataFrame:
    """Add `{prefix}base`, the base spans in order, and `{prefix}cand`, candidates with their votes and features."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.withColumn(f"{prefix}t", text)
    t = F.col(f"{prefix}t")
    out = out.withColumns({
        f"{prefix}email": _places(t, EMAIL, F.instr(t, "@") > 0),
        f"{prefix}ip": _places(t, IP, t.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")),
        f"{prefix}digits": _places(t, CARD, t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")),
        f"{prefix}phone": _places(t, PHONE, t.rlike(r"\+[0-9]")),
        f"{prefix}iban": _places(t, IBAN, t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}")),
        f"{prefix}mail": _places(t, MAIL, t.rlike(r"[\[(]\s?at\s?[\])]")),
        f"{prefix}secret": _places(t, SECRET, t.rlike(r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key)[\"']?\s{0,3}[:=]")),
        f"{prefix}ssn": _places(t, SSN, t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]")),
        f"{prefix}tel": _places(t, TEL, t.rlike(r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}")),
    })

    def col(name: str) -> Column:
        return F.col(prefix + name)

    def kept(name: str, ok: Callable[[Column], Column] | None = None) -> Column:
        return F.filter(col(name), lambda x: ok(x["m"])) if ok else col(name)

    card = lambda m: F.when(_size_between(m, 14, 19), _luhn(m)).otherwise(False)
    base = {"email": kept("email"), "ip": kept("ip", _small_parts), "card": kept("digits", card),
            "phone": kept("phone", lambda m: _size_between(m, 10, 15))}
    added = {"iban": kept("iban"), "mail": kept("mail"), "number": kept("digits", lambda m: _size_between(m, 13, 19) & ~card(m)),
             "secret": kept("secret"), "ssn": kept("ssn"), "tel": kept("tel")}

    def of_kind(kind: str) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e"))

    def spans(found: dict[str, Column]) -> Column:
        return F.array_sort(F.concat(*[F.transform(f, of_kind(n)) for n, f in found.items()]))

    out = out.withColumn(f"{prefix}base", spans(base))
    # A candidate is clear of base spans if those that start before its end have ended by its start.
    ends = F.concat(
        F.transform(col("base"), lambda b: F.struct(b["s"].alias("at"), F.lit(1).alias("base"), b["s"].alias("s"), b["k"].alias("k"), b["e"].alias("e"))),
        F.transform(spans(added), lambda c: F.struct(c["e"].alias("at"), F.lit(0).alias("base"), c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"))))
    judged = _running(F.array_sort(ends), lambda x: F.when(x["base"] == 1, x["e"]).otherwise(0), F.greatest,
                      lambda x, last: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), ((x["base"] == 0) & (last <= x["s"])).alias("clear")))
    loose = F.array_sort(F.transform(F.filter(judged, lambda x: x["clear"]), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))
    pieces = lambda cs: F.when(F.size(cs) > 0, _pieces(t))
    out = out.withColumn(f"{prefix}cand", _bound(loose, lambda cs: _bound(pieces(cs), lambda ps: F.transform(cs, lambda c: _candidate(ps, c)))))
    return out.drop(*[prefix + n for n in ("t", "email", "ip", "digits", "phone", "iban", "mail", "secret", "ssn", "tel")])


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("0")


def _candidate(pieces: Column, c: Column) -> Column:
    """A candidate with the votes of the labelers and the features of the classifier."""
    around = F.struct(_cut(pieces, c["s"], c["e"]).alias("m"), _cut(pieces, F.greatest(c["s"] - CONTEXT, F.lit(0)), c["s"]).alias("before"),
                      _cut(pieces, c["e"], c["e"] + CONTEXT).alias("after"))
    return _bound(around, lambda x: _judged(c, x["m"], x["before"], x["after"]))


def _judged(c: Column, m: Column, before: Column, after: Column) -> Column:
    number, secret, tel, ssn = (c["k"] == KINDS.index(n) for n in ("number", "secret", "tel", "ssn"))
    digits = _digits(m)
    strict = F.when(number, digits.rlike("^(?:[0-9]{16}|3[47][0-9]{13})$")).when(secret, m.rlike("[0-9a-fA-F]{32}")).when(
        tel, m.rlike(r"^\([0-9]{3}\)|^[0-9]{3}[.-]")).otherwise(F.lit(True))
    votes = F.concat(
        _vote(strict, ~strict),  # the kind's strict shape
        _vote(number & F.when(number, _luhn(m)).otherwise(False), number & ~digits.rlike("^[2-6]")),  # checksum, or an issuer's first digit
        _vote(before.rlike(FOR_WORDS) | secret, before.rlike(AGAINST_WORDS)),  # gazetteers of words before the span
        _vote((before == "") | before.rlike(r"[\s(\[\"':,;]$"), before.rlike(r"[A-Za-z0-9#/=._-]$")),  # what stands before
        _vote((after == "") | after.rlike(r"^[\s)\]\"',;.!?*&%$#]"), after.rlike("^[A-Za-z0-9/=_-]")),  # what stands after
        _vote(ssn & ~m.rlike("^(?:000|666|9)"), m.rlike(r"^(?:0{3,}|1{5,}|(?:1234)+)") | (ssn & m.rlike("^(?:000|666|9)"))),  # values never given out
    )
    features = F.array(
        F.concat(F.lit("kind:"), c["k"].cast("string")),
        F.concat(F.lit("size:"), c["k"].cast("string"), F.lit(":"), F.char_length(digits).cast("string")),
        F.concat(F.lit("shape:"), F.substring(F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[a-zA-Z]+", "a"), "[0-9]+", "9"), r"\s+", " "), 1, 16)),
        F.concat(F.lit("before:"), F.pmod(F.xxhash64(F.lower(F.regexp_extract(before, r"([\p{L}]*)[^\p{L}]{0,3}$", 1))), F.lit(256)).cast("string")),
        F.concat(F.lit("left:"), F.when(before == "", "").otherwise(F.regexp_replace(F.regexp_replace(F.right(before, F.lit(1)), r"\p{L}", "a"), "[0-9]", "9"))),
        F.concat(F.lit("right:"), F.regexp_replace(F.regexp_replace(F.left(after, F.lit(1)), r"\p{L}", "a"), "[0-9]", "9")),
    )
    return F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"), votes.alias("votes"), F.transform(features, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")).alias("features"))


def reliabilities(patterns: dict[str, int], settled: float = SETTLED) -> tuple[float, list[tuple[float, float]], dict[str, float]]:
    """EM over vote patterns: the share of true spans, each labeler's chance to vote for a true and a false one, each pattern's chance.

    Rounds go on until no pattern's chance moves by more than `settled`.
    """
    if not patterns:
        return 0.5, [], {}
    n = len(next(iter(patterns)))
    chance = {p: (1 + p.count("+")) / (2 + p.count("+") + p.count("-")) for p in patterns}
    share, rates = 0.5, [(0.7, 0.3)] * n
    moved = 1.0
    while moved > settled:
        total = sum(patterns.values())
        share = min(max((sum(patterns[p] * chance[p] for p in patterns) + 1) / (total + 2), 0.01), 0.99)
        rates = []
        for j in range(n):
            both = []
            for true in (True, False):
                weight = {p: patterns[p] * (chance[p] if true else 1 - chance[p]) for p in patterns if p[j] != "0"}
                for_it = sum(w for p, w in weight.items() if p[j] == "+")
                # A prior of ten votes keeps "for" the likelier of true spans.
                both.append((for_it + (7 if true else 3)) / (sum(weight.values()) + 10))
            rates.append((both[0], both[1]))
        moved = 0.0
        for p in patterns:
            odds = math.log(share / (1 - share))
            for vote, (a, b) in zip(p, rates):
                odds += math.log(a / b) if vote == "+" else math.log((1 - a) / (1 - b)) if vote == "-" else 0
            now = 1 / (1 + math.exp(-max(min(odds, 30), -30)))
            moved, chance[p] = max(moved, abs(now - chance[p])), now
    return share, rates, chance


@dataclass(frozen=True)
class Classifier:
    """Log odds of a true span by feature, and those before any feature."""

    prior: float
    weights: dict[int, float]

    def accepts(self, c: Column, least: float = LEAST_CHANCE) -> Column:
        if not self.weights:
            return F.lit(False)
        table = F.array(*[F.lit(self.weights.get(f, 0.0)) for f in range(BUCKETS)])
        odds = F.aggregate(c["features"], F.lit(self.prior), lambda acc, f: acc + F.get(table, f))
        return odds >= math.log(least / (1 - least))


def fit(annotated: DataFrame, prefix: str = "__") -> Classifier:
    """Estimate the labelers' reliabilities on all candidates and train the span classifier on the chances they give.

    What comes to the driver are counts per vote pattern and feature: both tables are bounded.
    """
    cands = annotated.select(F.explode(f"{prefix}cand").alias("c")).select("c.votes", F.explode("c.features").alias("f"))
    counts = cands.groupBy("votes", "f").agg(F.count(F.lit(1)).alias("n")).collect()
    per = len({r["f"] for r in counts}) and 6  # features per candidate
    patterns: dict[str, int] = {}
    for r in counts:
        patterns[r["votes"]] = patterns.get(r["votes"], 0) + r["n"]
    patterns = {p: n // per for p, n in patterns.items()}
    _, _, chance = reliabilities(patterns)
    yes: dict[int, float] = {}
    no: dict[int, float] = {}
    for r in counts:
        yes[r["f"]] = yes.get(r["f"], 0.0) + r["n"] * chance[r["votes"]]
        no[r["f"]] = no.get(r["f"], 0.0) + r["n"] * (1 - chance[r["votes"]])
    a, b = sum(yes.values()) / max(per, 1), sum(no.values()) / max(per, 1)
    prior = math.log((a + 1) / (b + 1))
    weights = {}
    for f in yes:
        usual = SMOOTHING * (yes[f] + no[f]) / (a + b)  # a feature seen rarely tells little either way
        weights[f] = math.log((yes[f] + usual) / (a + SMOOTHING)) - math.log((no[f] + usual) / (b + SMOOTHING))
    return Classifier(prior, weights)


def all_spans(model: Classifier, prefix: str = "__") -> Column:
    """Base spans and accepted candidates, in order."""
    added = F.transform(F.filter(F.col(f"{prefix}cand"), lambda c: model.accepts(c)), lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e")))
    return F.array_sort(F.concat(F.col(f"{prefix}base"), added))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows and columns of `docs`, each span of personal data in the text replaced by its kind in brackets.

    Of overlapping spans the first, and of those that start together the longer, names the
    replacement, which reaches to the end of the last. Null texts stay null.
    """
    known = annotate(docs, text_col)
    model = fit(known)
    text = F.col(text_col).cast("string")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def merged(spans: Column) -> Column:
        """The text with the first span of each overlapping run replaced, to the end of the run's last."""
        ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["k"].alias("k"))))
        heads = _running(ordered, lambda x: -x["e"], F.greatest, lambda x, last: F.struct(last.alias("from"), x["s"].alias("s"), x["k"].alias("k")))
        end = F.aggregate(spans, F.lit(0), lambda acc, x: F.greatest(acc, x["e"]))
        return _bound(_pieces(text), lambda ps: F.concat(
            F.array_join(F.transform(F.filter(heads, lambda x: x["s"] >= x["from"]), lambda x: F.concat(_cut(ps, x["from"], x["s"]), F.element_at(names, x["k"] + 1))), ""),
            _cut(ps, end, F.char_length(text))))

    clean = _bound(all_spans(model), lambda spans: F.when(F.size(spans) > 0, merged(spans)).otherwise(text))
    return known.withColumn(text_col, clean).select(*docs.columns)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every row: (doc_id, base, spans), arrays of (s, k, e): start, place in `KINDS`, end, in code points.

    Null and empty texts have none. One row per input row, also where ids repeat or are null;
    an empty table gives an empty table; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = stored(annotate(slim).drop("text"))
    model = fit(known)
    return known.select("doc_id", F.col("__base").alias("base"), all_spans(model).alias("spans"))
