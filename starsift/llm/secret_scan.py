"""Secret scan behind an inverted index of trigrams.

From each rule's pattern follows a Boolean query over trigrams that any match must
contain. The index lists, for every trigram some query asks for, the documents that
hold it (letter case aside); a rule's candidates are what is left after its postings
are united and intersected. Only they are searched with the pattern. Rules without
a mandatory trigram search every document.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import fresh_name

#: Literal variants followed through one pattern; beyond, the literal is cut there.
MAX_VARIANTS = 64
MAX_CLASS = 4


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds matches; one stays if ``group`` of it has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


#: The first three are fixed values of the job; the others add spans of their own kinds.
BASE_RULES = (
    SecretRule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    SecretRule("access", r"AKIA[A-Z0-9]+", 20),
    SecretRule("hex", r"[0-9a-f]+", 24),
)
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


# --- Boolean trigram queries -------------------------------------------------
# A query is True (every document), a trigram, or ("and" | "or", frozenset of queries).


def combine(kind: str, parts) -> object:
    parts = set(parts)
    if kind == "and":
        parts.discard(True)
    elif True in parts:
        return True
    if not parts:
        return True
    return parts.pop() if len(parts) == 1 else (kind, frozenset(parts))


def literal_query(variants: set[str]) -> object:
    """What a text has that holds one of the literals."""
    return combine("or", (combine("and", {v[i : i + 3] for i in range(len(v) - 2)}) for v in variants))


def exact(node) -> set[str] | None:
    """All texts a part of a pattern matches, lower-cased, if they are few."""
    kind, value = node
    if kind is sre.LITERAL:
        return {chr(value).lower()}
    if kind is sre.IN:
        chars = set()
        for k, v in value:
            if k is not sre.LITERAL:
                return None
            chars.add(chr(v).lower())
        return chars if len(chars) <= MAX_CLASS else None
    if kind is sre.SUBPATTERN:
        return exact_all(value[-1])
    if kind is sre.BRANCH:
        sides = [exact_all(side) for side in value[1]]
        return None if any(s is None for s in sides) else set().union(*sides)
    if kind is sre.MAX_REPEAT and value[1] == 1:
        inner = exact_all(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def exact_all(nodes) -> set[str] | None:
    texts = {""}
    for node in nodes:
        own = exact(node)
        if own is None or len(texts) * len(own) > MAX_VARIANTS:
            return None
        texts = {a + b for a, b in product(texts, own)}
    return texts


def inner_query(node) -> object:
    """What a part that has no short list of texts still demands."""
    kind, value = node
    if kind is sre.SUBPATTERN:
        return sequence_query(value[-1])
    if kind is sre.BRANCH:
        return combine("or", (sequence_query(side) for side in value[1]))
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
        return sequence_query(value[2])
    return True


def sequence_query(nodes) -> object:
    """Trigrams of the literals that follow each other without a gap, and of the inner parts."""
    parts, run = [], {""}
    for node in nodes:
        own = exact(node)
        if own is not None and len(run) * len(own) <= MAX_VARIANTS:
            run = {a + b for a, b in product(run, own)}
            continue
        parts.append(literal_query(run))
        run = own if own is not None else {""}
        if own is None:
            parts.append(inner_query(node))
    return combine("and", [*parts, literal_query(run)])


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a pattern; True if it has no mandatory trigram."""
    return sequence_query(sre_parser.parse(pattern))


def trigrams_of(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def holds(query: object, grams: Column) -> Column:
    """Whether a document's postings satisfy a query."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(grams, query)
    join = (lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b)
    return reduce(join, (holds(q, grams) for q in sorted(query[1], key=str)))


# --- index and candidates ----------------------------------------------------


def postings(docs: DataFrame, rules: tuple[SecretRule, ...], doc_id: str, text: str) -> DataFrame:
    """The inverted index as (trigram, doc_id) rows, for the trigrams the rules ask for."""
    wanted = sorted(set().union(*(trigrams_of(trigram_query(r.pattern)) for r in rules)))
    folded = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.lower(F.col(f"`{text}`")).alias("folded"))
    held = F.array_compact(F.array(*[F.when(F.col("folded").contains(g), F.lit(g)) for g in wanted]))
    return folded.select("doc_id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[SecretRule, ...]) -> DataFrame:
    """(doc_id, kinds): the indexed rules whose query the document's postings satisfy."""
    asked = [(r, q) for r in rules if (q := trigram_query(r.pattern)) is not True]
    held = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("grams"))
    kinds = F.array_compact(F.array(*[F.when(holds(q, F.col("grams")), F.lit(r.kind)) for r, q in asked]))
    return held.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


# --- verification ------------------------------------------------------------


def found_spans(rule: SecretRule, order: int, text: Column) -> Column:
    """Array of (start, rank, end, kind): leftmost non-overlapping matches that are long enough, in code points.

    The pieces between matches and the matches themselves alternate, so their
    lengths give the positions.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    pieces = F.slice(F.split(text, rule.pattern, -1), 1, F.size(whole))
    rows = F.zip_with(pieces, F.zip_with(whole, kept, lambda w, k: F.struct(F.length(w).alias("n"), F.length(k).alias("own"))),
                      lambda p, m: F.struct(F.length(p).alias("gap"), m["n"].alias("n"), m["own"].alias("own")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    walked = F.aggregate(
        rows,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda done, m: F.struct(
            (done["at"] + m["gap"] + m["n"]).alias("at"),
            F.when(
                m["own"] >= rule.least,
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            (done["at"] + m["gap"]).alias("start"),
                            F.lit(order).alias("rank"),
                            (done["at"] + m["gap"] + m["n"]).alias("end"),
                            F.lit(rule.kind).alias("kind"),
                        )
                    ),
                ),
            ).otherwise(done["spans"]).alias("spans"),
        ),
    )["spans"]
    return F.when(text.rlike(searched(rule)), walked).otherwise(none)


def searched(rule: SecretRule) -> str:
    """A pattern for whether any match is long enough: a closing ``+`` of the measured part is counted out."""
    if rule.group == 0 and rule.least > 1 and rule.pattern.endswith("]+"):
        fixed = rule.pattern[: rule.pattern.rindex("[")]
        return f"{rule.pattern[:-1]}{{{rule.least - len(fixed)},}}"
    return rule.pattern


def scan(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", rules: tuple[SecretRule, ...] = RULES, out: str = "spans") -> DataFrame:
    """Columns ``keep`` with ``spans`` (or another name, ``out``): array of (start, rank, end, kind) by start, then in the order of the rules.

    Positions are code points, the end exclusive. Null and empty texts have no
    spans. Rows with a null or repeated id are judged by their own text: an id's
    candidates are those of all its rows, and the pattern decides. Only built-in
    functions run here.
    """
    found = candidates(postings(docs.where(F.col(f"`{doc_id}`").isNotNull()), rules, doc_id, text), rules)
    own = {c: f"d_{c}" for c in docs.columns}
    renamed = docs.withColumnsRenamed(own)
    key = F.col(f"`d_{doc_id}`")
    known = renamed.where(key.isNotNull()).join(found, key == found["doc_id"], "left").drop("doc_id")
    every = F.array(*[F.lit(r.kind) for r in rules])
    unknown = renamed.where(key.isNull()).withColumn("kinds", every)
    rows = known.unionByName(unknown)
    body = F.coalesce(F.col(f"`d_{text}`"), F.lit(""))
    lists = []
    for order, rule in enumerate(rules):
        spans = found_spans(rule, order, body)
        if trigram_query(rule.pattern) is not True:
            none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(none)
        lists.append(spans)
    return rows.select(*[F.col(f"`d_{c}`").alias(c) for c in keep], F.array_sort(F.concat(*lists)).alias(out))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = "[redacted]", rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Documents with every found span replaced by ``mark``; overlapping spans become one. All rows and columns stay."""
    name = fresh_name(docs, "found_spans")
    rows = scan(docs, docs.columns, doc_id, text, rules, name)
    body = F.col(f"`{text}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(
        name,
        start,
        lambda done, s: F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] >= done["at"], F.concat(done["out"], body.substr(done["at"] + 1, s["start"] - done["at"]), F.lit(mark)))
            .otherwise(done["out"])
            .alias("out"),
        ),
    )
    clean = F.concat(walked["out"], body.substr(walked["at"] + 1, F.length(body)))
    return rows.withColumn(text, F.when(F.size(name) > 0, clean).otherwise(body)).select(*[F.col(f"`{c}`") for c in docs.columns])
