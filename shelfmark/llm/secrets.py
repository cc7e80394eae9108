"""Secrets in texts: a trigram inverted index finds candidates, regular expressions verify them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import trigrams
from shelfmark.session import stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    Matches are leftmost and don't overlap; those that are too short are dropped after that.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: Fixed: the three base kinds, in their order. Runs of one class are matched whole, so a minimum
#: in the expression selects the same matches as one after it.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
)
#: Kinds beside them.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
_SPAN, _WITH_SIZE = "array<struct<start:int,kind:int,end:int>>", "array<struct<start:int,kind:int,end:int,of:int>>"
#: Matches whose places are summed up one after another.
STRETCH = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _running(sizes: Column, at: Column, element: Callable[[Column, Column], Column], length: Callable[[Column], Column], kind: str) -> Column:
    """``element(where it starts, s)`` for each of ``sizes``, laid one after another from ``at`` on."""

    def step(state: Column, s: Column) -> Column:
        return F.struct((state["at"] + length(s)).alias("at"), F.concat(state["out"], F.array(element(state["at"], s))).alias("out"))

    return F.aggregate(sizes, F.struct(at.alias("at"), F.array().cast(kind).alias("out")), step, lambda state: state["out"])


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans in code points: what lies between matches gives their places."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)
    sizes = F.zip_with(
        F.zip_with(whole, part, lambda w, p: F.struct(F.length(w).alias("long"), F.length(p).alias("of"))),
        F.slice(gaps, 1, F.greatest(F.size(whole), F.lit(0))),
        lambda m, g: F.struct(F.length(g).alias("gap"), m["long"].alias("long"), m["of"].alias("of")),
    )

    def span(at: Column, m: Column) -> Column:
        start = at + m["gap"]
        return F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + m["long"]).alias("end"), m["of"].alias("of"))

    def size(m: Column) -> Column:
        return m["gap"] + m["long"]

    def placed(sizes: Column) -> Column:
        # stretch by stretch, as arrays that grow by one element are copied each time
        starts = F.when(F.size(sizes) > 0, F.sequence(F.lit(1), F.size(sizes), F.lit(STRETCH))).otherwise(F.array().cast("array<int>"))
        stretches = F.transform(starts, lambda at: F.slice(sizes, at, F.lit(STRETCH)))
        sums = F.transform(stretches, lambda x: F.struct(x.alias("x"), F.aggregate(x, F.lit(0), lambda a, m: a + size(m)).alias("sum")))
        based = _let(sums, lambda s: F.zip_with(s, _running(s, F.lit(0), lambda at, _: at, lambda x: x["sum"], "array<int>"), lambda x, at: F.struct(x["x"].alias("x"), at.alias("at"))))
        return F.flatten(F.transform(based, lambda s: _running(s["x"], s["at"], span, size, _WITH_SIZE)))

    kept = F.filter(_let(sizes, placed), lambda m: m["of"] >= rule.least)
    found = F.transform(kept, lambda m: F.struct(m["start"], m["kind"], m["end"]))
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(_SPAN))


def index(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """(trigram, i): the postings of all trigrams that some rule asks for, in the shared folder."""
    asked = sorted({t for r in rules for s in trigrams.query(r.pattern) or [] for t in s})
    low = docs.select(docs[id_col].alias("i"), F.lower(docs[text_col]).alias("low")).where("low is not null")
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in asked]))
    postings = low.select("i", F.explode(present).alias("trigram"))
    return stored(postings.select("trigram", "i").distinct(), "trigram-postings")


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(i, kinds): for which documents the postings satisfy which rules' queries.

    Rules without mandatory trigrams aren't in it: they scan every text. The postings of a document
    are as many as the rules have trigrams at most.
    """
    has = F.collect_set("trigram").alias("has")
    asked = [(n, q) for n, r in enumerate(rules) if (q := trigrams.query(r.pattern)) is not None]

    def holds(q: list[frozenset[str]]) -> Column:
        each = [reduce(Column.__and__, [F.array_contains("has", t) for t in sorted(s)]) for s in q]
        return reduce(Column.__or__, each)

    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(n)) for n, q in asked]))
    return postings.groupBy("i").agg(has).select("i", kinds.alias("kinds")).where("size(kinds) > 0")


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (), out: str = "spans",
) -> DataFrame:
    """(id, text, ``out``, kept columns): every row with its spans, by start and then by rule.

    A span is (start, kind, end): code points, the end not included, the rule's number. Spans of
    different rules may overlap. Null texts count as empty and have none. Rows may repeat and ids
    may be null or repeat: candidates of one id are candidates of all its rows, and each row is
    verified by itself. Only DataFrame functions are used.
    """
    if not any(trigrams.query(r.pattern) for r in rules):
        raise ValueError("no rule has a mandatory trigram: there is nothing to index")
    wanted = docs.select(docs[id_col].alias("i"), F.coalesce(docs[text_col], F.lit("")).alias("t"), *(docs[c].alias(f"keep_{c}") for c in keep))
    likely = candidates(index(docs, rules, id_col, text_col), rules).withColumnRenamed("i", "j")
    rows = wanted.join(likely, wanted["i"].eqNullSafe(likely["j"]), "left")
    parts = []
    for n, rule in enumerate(rules):
        found = _spans(F.col("t"), rule, n)
        if trigrams.query(rule.pattern) is not None:
            found = F.when(F.array_contains("kinds", n), found).otherwise(F.array().cast(_SPAN))
        parts.append(found)
    spans = F.array_sort(F.concat(*parts)).alias(out)
    return rows.select(F.col("i").alias(id_col), F.col("t").alias(text_col), spans, *(F.col(f"keep_{c}").alias(c) for c in keep))


def joined(spans: Column, rules: tuple[Rule, ...] = RULES, base: bool = False) -> Column:
    """``kind:start:end`` of the spans, or of those of base kinds, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    if base:
        spans = F.filter(spans, lambda s: s["kind"].isin([n for n, r in enumerate(rules) if r.base]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = scan(docs, RULES, id_col, text_col)

    def count(n: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")

    return found.select(
        id_col, *(count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)),
        F.sha2(joined(F.col("spans"), base=True), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column, sign: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``sign``."""

    def step(state: Column, s: Column) -> Column:
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.when(
            s["start"] >= state["at"],
            F.struct(s["end"].alias("at"), F.concat(state["out"], before, F.lit(sign)).alias("out")),
        ).otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
