"""Personal data and secrets in texts, by DataFrame functions only.

Mail addresses, network addresses, payment cards and telephone numbers are found by fixed patterns with checks. Secrets
have no fixed form: labelers (regular expressions, a gazetteer of key words, the context) vote on every candidate, an
expectation-maximisation over the vote patterns estimates how reliable each labeler is, and a span classifier trained on
the estimated labels decides from the form of the span. What reaches the driver are counts by vote pattern and by form,
at most 3**labelers and 2**features rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import stored

# The patterns of the contract. Repetitions are possessive where nothing can follow that they would have
# to give back, and runs are entered at their first character (or where the last match ended), so that no text recurses
# deeply or costs more than linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "secret")

# a run of eight key characters or more with a digit in it
RUN = r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{8,}+"
KEYS = r"(?i:password|passwd|pwd|secret|token|credential|api[_-]?key|access[_-]?key|auth)[\"']?"
KEY_WORD = KEYS + r"\s*(?:[:=]|is)?\s*[\"']?$"
# what is assigned to a key word, of any length and form: up to the closing quote of the line, or else a run without
# blanks that ends before closing punctuation, the next name=value pair or markup
ASSIGNED = KEYS + r"\s{0,8}[:=]{1,2}>?\s{0,8}"
APART = r"(?![,;&][A-Za-z0-9_-]++[=:]|<[A-Za-z/!])"
CLOSING = r".,;:?)\]}\"'"
VALUE = (
    r"(?:(?<=\")[^\"\\\n]*+(?:\\[^\n][^\"\\\n]*+)*+(?<=[^\"\s])(?=\")|(?<=')[^'\\\n]*+(?:\\[^\n][^'\\\n]*+)*+(?<=[^'\s])(?=')"
    rf"|(?![=:>\"'\s])(?:(?:{APART}[{CLOSING}])*+{APART}[^\s{CLOSING}])++)"
)
# the short look behind spares most places the long one
CANDIDATE = rf"(?<=[:=>\s\"'])(?<=[:=]>?\s{{0,8}}[\"']?)(?<={ASSIGNED}[\"']?){VALUE}|{RUN}"
# characters before a candidate that are looked at; so many candidates and the pieces between them have as many
CONTEXT, BACK = 32, 16
BLOCK = 256
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda uses it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def located(text: Column, pattern: str, context: bool = False) -> Column:
    """``array<struct<start, end, hit>>`` of the leftmost matches of a pattern, in code points, end exclusive.

    The pieces between the matches give the places: their lengths are added up in blocks, so the work stays far from
    quadratic in the number of matches. With ``context`` the CONTEXT characters before a match (``left``) and the one
    after it (``right``) are added, also from the pieces: the whole text is not entered again for each match.
    """
    kind = f"array<struct<start:int,end:int,hit:string{',left:string,right:string' if context else ''}>>"

    def placed(found: Column) -> Column:
        hits, gaps = found["hits"], found["gaps"]

        def sides(i: Column) -> list[Column]:
            before = [piece for k in range(BACK, 0, -1) for piece in (F.get(hits, i - k), F.get(gaps, i - k + 1))]
            left = F.substring(F.concat_ws("", *before), -CONTEXT, CONTEXT)
            return [left.alias("left"), F.substring(F.get(gaps, i + 1), 1, 1).alias("right")] if context else []

        steps = F.transform(hits, lambda h, i: F.char_length(h) + F.char_length(F.get(gaps, i)))

        def starts(s: Column) -> Column:
            def start(h: Column, i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                return _total(F.slice(s["sums"], F.lit(1), block)) + _total(F.slice(s["steps"], block * BLOCK + 1, i - block * BLOCK)) + F.char_length(F.get(gaps, i))

            return F.transform(hits, lambda h, i: let(start(h, i), lambda at: F.struct(at.alias("start"), (at + F.char_length(h)).alias("end"), h.alias("hit"), *sides(i))))

        blocks = lambda s: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")), lambda b: _total(F.slice(s, b * BLOCK + 1, F.lit(BLOCK)))
        )
        return let(steps, lambda s: let(F.struct(s.alias("steps"), blocks(s).alias("sums")), starts))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(hits, lambda h: F.when(F.size(h) == 0, F.array().cast(kind)).otherwise(
        let(F.struct(h.alias("hits"), F.split(text, pattern, -1).alias("gaps")), placed).cast(kind)
    ))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True where the check digit is right: from the right, every second digit is doubled and 9 taken off above 9."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.coalesce(d.cast("int"), F.lit(0)) * (F.lit(1) + i % 2))
    return _total(F.transform(values, lambda v: F.when(v > 9, v - 9).otherwise(v))) % 10 == 0


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return let(_digits(hit), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def span_of(place: Column, kind: str) -> Column:
    rank = F.lit(KINDS.index(kind))
    return F.struct(place["start"].alias("start"), rank.alias("rank"), place["end"].alias("end"), F.lit(kind).alias("kind"))


def base_spans(text: Column) -> Column:
    """Sorted spans ``(start, rank, end, kind)`` of the four fixed kinds."""

    def found(kind: str, pattern: str, needed: Column) -> Column:
        passed = F.filter(located(text, pattern), lambda s: _passes(kind, s["hit"]))
        spans = F.transform(passed, lambda s: span_of(s, kind)).cast(SPAN)
        return F.when(needed, spans).otherwise(F.array().cast(SPAN))

    always, at, plus = F.lit(True), F.contains(text, F.lit("@")), F.contains(text, F.lit("+"))
    return F.array_sort(
        F.concat(found("email", EMAIL, at), found("ip", IP, always), found("card", CARD, always), found("phone", PHONE, plus))
    )


# ---------------------------------------------------------------- candidates, labelers, features


def labelers(value: Column, left: Column, right: Column, in_base: Column) -> dict[str, Column]:
    """Votes on a candidate: 1 a secret, -1 none, 0 no opinion."""
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    assigned = left.rlike(ASSIGNED + "[\"']?$")
    return {
        "hex_form": F.when(value.rlike("^(?:[0-9a-f]{16,}|[0-9A-F]{16,})$") & value.rlike("[A-Fa-f]"), yes).otherwise(none),
        "mixed_form": F.when(~assigned & (value.rlike("^[0-9-]+$") | (F.length(value) < 10)), no)
        .when((F.length(value) >= 16) & value.rlike("[0-9].*[A-Za-z].*[0-9]"), yes).otherwise(none),
        "key_word": F.when(left.rlike(KEY_WORD), yes).otherwise(none),
        "assigned": F.when(assigned, yes).otherwise(none),
        "context": F.when(left.rlike(r"[=:]\s*[\"']?$"), yes).when(left.rlike(r"(?:^|[A-Za-z,.;])\s$"), no).otherwise(none),
        "quotes": F.when(left.rlike("[\"']$") & right.rlike("^[\"']"), yes).otherwise(none),
        "other_kind": F.when(in_base, no).otherwise(none),
    }


def form(value: Column, left: Column, in_base: Column) -> dict[str, Column]:
    """What the span classifier sees: the form of the span and the characters before it, as yes or no."""
    return {
        "twelve": F.length(value) >= 12,
        "sixteen": F.length(value) >= 16,
        "thirty": F.length(value) >= 30,
        "letters": value.rlike("[A-Za-z]"),
        "digits_only": value.rlike("^[0-9-]+$"),
        "hex_only": value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "alternates": value.rlike("[0-9][A-Za-z]+[0-9]+[A-Za-z]"),
        "assigned": left.rlike(r"[=:]\s*[\"']?$"),
        "keyed": left.rlike(KEY_WORD),
        "in_base": in_base,
    }



def blocked(spans: Column) -> Column:
    """Sorted spans in blocks, each with the stretch of text it lies in."""
    last = F.greatest(F.floor((F.size(spans) - 1) / BLOCK).cast("int"), F.lit(0))

    def block(part: Column) -> Column:
        first, end = F.array_min(F.transform(part, lambda s: s["start"])), F.array_max(F.transform(part, lambda s: s["end"]))
        return F.struct(F.coalesce(first, F.lit(0)).alias("start"), F.coalesce(end, F.lit(0)).alias("end"), part.alias("spans"))

    return F.transform(F.sequence(F.lit(0), last), lambda b: let(F.slice(spans, b * BLOCK + 1, F.lit(BLOCK)), block))


def overlapped(c: Column, blocks: Column, wholly: bool = False) -> Column:
    """True where a span of ``blocked`` spans overlaps ``c``, or holds it ``wholly``; blocks elsewhere are passed over."""

    def meets(s: Column) -> Column:
        return (s["start"] <= c["start"]) & (s["end"] >= c["end"]) if wholly else (s["start"] < c["end"]) & (s["end"] > c["start"])

    return F.exists(blocks, lambda b: meets(b) & F.exists(b["spans"], meets))


def candidates(text: Column, base: Column) -> Column:
    """``array<struct<start, end, votes, form>>``: votes and form as strings of one character per labeler or feature."""

    def judged(c: Column, blocks: Column) -> Column:
        def written(in_base: Column) -> Column:
            votes = F.concat(*[(v + 1).cast("string") for v in labelers(c["hit"], c["left"], c["right"], in_base).values()])
            seen = F.concat(*[f.cast("int").cast("string") for f in form(c["hit"], c["left"], in_base).values()])
            return F.struct(c["start"].alias("start"), c["end"].alias("end"), votes.alias("votes"), seen.alias("form"))

        return let(overlapped(c, blocks, wholly=True), written)

    return let(blocked(base), lambda blocks: F.transform(located(text, CANDIDATE, context=True), lambda c: judged(c, blocks)))


# ---------------------------------------------------------------- learning from votes


@dataclass(frozen=True)
class LabelModel:
    """``prior`` of a secret and, per labeler, the probabilities of its three votes in each class."""

    prior: float
    votes: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        if not patterns:
            return np.zeros(0)
        at = np.array([[int(c) for c in p] for p in patterns])
        logs = np.log([1 - self.prior, self.prior]) + sum(np.log(self.votes[k, :, at[:, k]]) for k in range(at.shape[1]))
        share = np.exp(logs - logs.max(axis=1, keepdims=True))
        return share[:, 1] / share.sum(axis=1)


def estimate_reliabilities(patterns: list[str], counts: np.ndarray, steps: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns (digits 0, 1, 2 for against, silent, for), from the majority vote.

    Votes are smoothed by one, so a labeler that never speaks has no influence. No patterns give the prior 0.5.
    """
    width = len(patterns[0]) if patterns else 0
    at = np.array([[int(c) for c in p] for p in patterns]).reshape(len(patterns), width)
    score = (at - 1).sum(axis=1)
    belief = np.where(score > 0, 0.9, np.where(score < 0, 0.1, 0.5))
    model = LabelModel(0.5, np.full((width, 2, 3), 1 / 3))
    for _ in range(steps if patterns else 0):
        total = counts.sum()
        votes = np.ones((width, 2, 3))
        for k in range(width):
            for vote in range(3):
                mine = at[:, k] == vote
                votes[k, 1, vote] += (counts * belief)[mine].sum()
                votes[k, 0, vote] += (counts * (1 - belief))[mine].sum()
        votes /= votes.sum(axis=2, keepdims=True)
        model = LabelModel(float(((counts * belief).sum() + 1) / (total + 2)), votes)
        before, belief = belief, model.posterior(patterns)
        if np.abs(before - belief).max() < 1e-6:
            break
    return model


def fit_spans(forms: list[str], belief: np.ndarray, counts: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression (intercept first) on yes-or-no features with soft labels, by ridged Newton steps."""
    x = np.array([[1.0, *map(float, f)] for f in forms])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (counts * (belief - p)) - ridge * weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass(frozen=True)
class SpanModel:
    """Forms (one character per feature) the classifier accepts as secrets; forms not seen are judged by weight."""

    weights: tuple[float, ...]

    def accepts(self, seen: Column) -> Column:
        total = F.lit(float(self.weights[0]))
        for k, w in enumerate(self.weights[1:]):
            total = total + F.substring(seen, k + 1, 1).cast("double") * float(w)
        return total >= 0


def learn_spans(found: DataFrame) -> SpanModel | None:
    """Label model and span classifier from all candidates (``cands``) of a table; None without candidates."""
    each = found.select(F.explode("cands").alias("c")).select("c.votes", "c.form")
    counted = stored(each.groupBy("votes", "form").agg(F.count("*").alias("n")), "votes")
    by_votes = counted.groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").collect()
    if not by_votes:
        return None
    patterns = [r["votes"] for r in by_votes]
    model = estimate_reliabilities(patterns, np.array([float(r["n"]) for r in by_votes]))
    beliefs = found.sparkSession.createDataFrame(
        [(p, float(b)) for p, b in zip(patterns, model.posterior(patterns))], "votes string, belief double"
    )
    by_form = (
        counted.join(F.broadcast(beliefs), "votes").groupBy("form")
        .agg((F.sum(F.col("belief") * F.col("n")) / F.sum("n")).alias("belief"), F.sum("n").alias("n")).orderBy("form").collect()
    )
    weights = fit_spans([r["form"] for r in by_form], np.array([r["belief"] for r in by_form]), np.array([float(r["n"]) for r in by_form]))
    return SpanModel(tuple(weights.tolist()))


# ---------------------------------------------------------------- whole tables


def spot(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` with ``base`` spans and ``cands`` of every row, in one pass over the texts."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    both = let(body, lambda t: let(base_spans(t), lambda b: F.struct(b.alias("base"), candidates(t, b).alias("cands"))))
    return docs.select(*keep, both.alias("_found")).select(*keep, "_found.base", "_found.cands")


def all_spans(base: Column, cands: Column, model: SpanModel | None) -> Column:
    """Base spans and accepted candidates that lie wholly inside none of them, sorted; they may overlap."""
    if model is None:
        return base
    fresh = let(blocked(base), lambda blocks: F.filter(cands, lambda c: model.accepts(c["form"]) & ~overlapped(c, blocks, wholly=True)))
    added = F.transform(fresh, lambda c: span_of(c, "secret"))
    return F.array_sort(F.concat(base, added.cast(SPAN)))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``base`` and ``spans`` (arrays of start, rank, end, kind, in code points) of every row.

    Null counts as the empty text; rows without personal data have empty arrays; a table without candidates adds no
    spans. Repeated rows give repeated rows, null keys stay null, other columns are not looked at.
    """
    found = stored(spot(docs, text, [key]), "spans")
    model = learn_spans(found)
    return found.select(key, "base", all_spans(F.col("base"), F.col("cands"), model).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the place."""

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["upto"]
        between = F.substring(text, done["upto"] + 1, F.greatest(s["start"] - done["upto"], F.lit(0)))
        out = F.when(fresh, F.concat(done["out"], between, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(done["out"])
        return F.struct(F.greatest(done["upto"], s["end"]).alias("upto"), out.alias("out"))

    start = F.struct(F.lit(0).alias("upto"), F.lit("").alias("out"))
    close = lambda done: F.concat(done["out"], F.substring(text, done["upto"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, close))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the spans of its texts replaced; null texts stay null, all other columns and rows stay."""
    model = learn_spans(stored(spot(docs, text, []).select("cands").where("size(cands) > 0"), "spans"))
    body = docs[text].cast("string")
    clean = let(body, lambda t: let(base_spans(t), lambda b: redacted(t, all_spans(b, candidates(t, b), model))))
    return docs.withColumn(text, F.when(body.isNotNull(), clean))
