"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression; ``trigrams`` derives its Boolean trigram query. The index holds
postings (trigram, document) for the trigrams that any rule asks for. Postings are intersected, a
document is a candidate of a rule when a clause has all its trigrams, and the rule's expression
verifies candidates. Rules without mandatory trigrams scan every text.

Matches are leftmost and non-overlapping per rule. Spans are code points, end exclusive: they come
from the lengths of the matches and of what lies between them.

Defined cases: a null text is empty and has no spans; rows are told apart by id and a hash of the
text, null ids included, and repeated rows get equal results; a match that fails its rule's length
is dropped (what it covered is not searched again); an empty table gives an empty result; other
columns are ignored by ``scan`` and kept by ``redact``, except that names starting with
``_scan_`` are taken.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermolake.llm.common import stored
from thermolake.llm.trigrams import Clause, trigram_query


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0

    def clauses(self) -> list[Clause]:
        return trigram_query(self.pattern)

    def searched(self) -> str:
        """An expression with the same matches of at least the asked length, and fewer others.

        Matches of a repeated character class are whole runs, so short ones need not be found to be
        dropped: the class is repeated at least that often.
        """
        run = re.fullmatch(r"(\[(?!\^)[^\[\]\\]+\])\+", self.pattern)
        return f"{run[1]}{{{self.least},}}" if run and self.least and not self.group else self.pattern


# The three base rules.
BASE = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
]
# A private key from its first line to its END line; in a text that is cut, up to the last line that
# can only be a key's. Line ends may be written out or quoted. Possessive, so that no line is read twice.
KEY_BODY = (
    r"""(?:[\x20\t\r\n\\"'>]+n?(?:Proc-Type|DEK-Info):\x20?[A-Za-z0-9,-]+){0,2}"""
    r"""(?:[A-Za-z0-9+/=\x20\t\r\n\\"'>,]*+-----END\x20[A-Z\x20]*PRIVATE\x20KEY-----"""
    r"""|(?:[\x20\t\r\n\\"'>,+]++[A-Za-z0-9+/=]{16,}+)*+(?:[\x20\t\r\n\\"'>,+]++[A-Za-z0-9+/]++(?:==?|(?![\s\S])))?)"""
)
# Well-known shapes of keys, added to the base.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----" + KEY_BODY),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
]
RULES = BASE + MORE

MARK = "[SECRET]"
# Trigrams per mask column.
MASK_BITS = 62
KEY = ["_scan_id", "_scan_hash"]


def keyed(docs: DataFrame) -> DataFrame:
    """Add what tells rows apart; rows that agree in it have equal texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("_scan_text", text).withColumn("_scan_id", F.col("doc_id").cast("bigint")).withColumn(
        "_scan_hash", F.xxhash64(F.col("_scan_text"))
    )


def same_key(a: DataFrame, b: DataFrame) -> Column:
    return a["_scan_id"].eqNullSafe(b["_scan_id"]) & (a["_scan_hash"] == b["_scan_hash"])


def postings(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """The index: (trigram, document) for every trigram that a rule's query names."""
    asked = sorted({t for rule in rules for clause in rule.clauses() for t in clause})
    lower = F.lower("_scan_text")
    present = F.array_compact(F.array(*[F.when(F.contains(lower, F.lit(t)), F.lit(t)) for t in asked]))
    return rows.select(F.explode(present).alias("trigram"), *KEY)


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """Documents and the kinds of the rules that may match them.

    Postings are intersected as bits: a document's trigrams are gathered into masks (combined in
    the tasks before the shuffle), and a clause is met when all of its bits are set.
    """
    asked = sorted({t for rule in rules for clause in rule.clauses() for t in clause})
    place = {t: divmod(i, MASK_BITS) for i, t in enumerate(asked)}
    masks = []
    for word in range(-(-len(asked) // MASK_BITS)):
        bits = [x for t in asked if place[t][0] == word for x in (F.lit(t), F.lit(1 << place[t][1]).cast("bigint"))]
        masks.append(F.bit_or(F.coalesce(F.element_at(F.create_map(*bits), F.col("trigram")), F.lit(0))).alias(f"mask{word}"))
    held = index.groupBy(*KEY).agg(*masks)

    def met(clause: Clause) -> Column:
        out = F.lit(True)
        for word in range(len(masks)):
            wanted = F.lit(sum(1 << place[t][1] for t in clause if place[t][0] == word)).cast("bigint")
            out &= F.col(f"mask{word}").bitwiseAND(wanted) == wanted
        return out

    kinds = []
    for rule in rules:
        some = F.lit(False)
        for clause in rule.clauses():
            some |= met(clause)
        kinds.append(F.when(some, F.lit(rule.kind)))
    found = held.select(*KEY, F.array_compact(F.array(*kinds)).alias("kinds"))
    return found.filter(F.size("kinds") > 0)


def matches(rule: Rule) -> tuple[Column, Column, Column]:
    """Of ``_scan_text``: the matches, the group that is measured, and the parts between matches."""
    pattern, text = F.lit(rule.searched()), F.col("_scan_text")
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    group = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    return found, group, F.split(text, rule.searched(), -1)


def hits(rows: DataFrame, rules: list[Rule], kinds: Column | None, size: Callable = F.char_length) -> DataFrame:
    """Verified matches per row and rule: sizes of matches and parts between, lengths of groups."""
    lengths = lambda strings, of=size: F.transform(strings, of)
    per_rule = []
    for rule in rules:
        found, group, between = matches(rule)
        wanted = F.size(found) > 0
        if kinds is not None:
            wanted = F.when(F.array_contains(kinds, rule.kind), wanted).otherwise(False)
        entry = F.struct(
            F.lit(rule.kind).alias("kind"),
            lengths(found).alias("found"),
            lengths(group, F.char_length).alias("measured"),
            lengths(between).alias("between"),
        )
        per_rule.append(F.when(wanted, entry))
    return rows.select(*KEY, F.explode(F.array_compact(F.array(*per_rule))).alias("hit")).select(*KEY, "hit.*")


def plan_rules(rules: list[Rule]) -> tuple[list[Rule], list[Rule]]:
    """Rules that the index serves, and those that scan fully."""
    indexed = [rule for rule in rules if all(rule.clauses())]
    return indexed, [rule for rule in rules if rule not in indexed]


def find_candidates(rows: DataFrame, indexed: list[Rule]) -> DataFrame:
    """The postings are stored first: the index is read back, not the texts.

    The candidates are stored, too, so that Spark knows their size before it joins them with the texts.
    """
    return stored(candidates(stored(postings(rows, indexed), "postings"), indexed), "candidates")


def spans(docs: DataFrame, rules: list[Rule] = RULES, size: Callable = F.char_length) -> DataFrame:
    """One row per match: document key, kind, start and end, in the unit of ``size``."""
    rows = keyed(docs).select(*KEY, "_scan_text")
    indexed, scanned = plan_rules(rules)
    parts = []
    if scanned:
        parts.append(hits(rows, scanned, None, size))
    if indexed:
        likely = find_candidates(rows, indexed)
        joined = rows.join(likely, same_key(rows, likely)).select(rows["_scan_id"], rows["_scan_hash"], "_scan_text", "kinds")
        parts.append(hits(joined, indexed, F.col("kinds"), size))
    verified = parts[0]
    for part in parts[1:]:
        verified = verified.unionByName(part)
    # Repeated rows give equal hits; one set of them is kept.
    verified = verified.dropDuplicates([*KEY, "kind"])
    each = verified.select(*KEY, "kind", F.posexplode(F.arrays_zip("found", "measured", "between")).alias("nth", "at"))
    so_far = Window.partitionBy(*KEY, "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("at.found") + F.col("at.between")).over(so_far)
    least = F.coalesce(*[F.when(F.col("kind") == rule.kind, rule.least) for rule in rules])
    return (
        each.filter("at.found is not null")
        .withColumn("end", end)
        .filter(F.col("at.measured") >= least)
        .select(*KEY, "kind", (F.col("end") - F.col("at.found")).alias("start"), "end")
    )


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per row: doc_id and ``found``, an array of (start, place of the rule, kind, end) in order."""
    order = F.coalesce(*[F.when(F.col("kind") == rule.kind, i) for i, rule in enumerate(rules)])
    entry = F.struct("start", order.alias("rule"), "kind", "end")
    found = spans(docs, rules).groupBy(*KEY).agg(F.array_sort(F.collect_list(entry)).alias("found"))
    rows = keyed(docs).select("doc_id", *KEY)
    none = F.array().cast(found.schema["found"].dataType)
    return rows.join(found, same_key(rows, found), "left").select("doc_id", F.coalesce("found", none).alias("found"))


def written(found: Column | str) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def covered(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per document key: ``_scan_ranges``, the bytes that matches of any rule cover, in order.

    Ranges that overlap, of whichever rules, are one.
    """
    found = spans(docs, rules, F.octet_length)
    in_order = Window.partitionBy(*KEY).orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")
    nth = F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    merged = found.withColumn("opens", opens).withColumn("nth", nth)
    merged = merged.groupBy(*KEY, "nth").agg(F.min("start").cast("int").alias("start"), F.max("end").cast("int").alias("end"))
    return merged.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_scan_ranges"))


def redact(docs: DataFrame, rules: list[Rule] = RULES, mark: str = MARK) -> DataFrame:
    """All rows and columns, with ``mark`` in place of what the spans of ``scan`` cover.

    Spans are those of the text as it came; where spans of several rules overlap, all that they
    cover together is marked once. A null text stays null.
    """
    columns = docs.columns
    rows, ranges = keyed(docs), stored(covered(docs, rules), "ranges")
    rows = rows.join(ranges, same_key(rows, ranges), "left").select(*[rows[c] for c in rows.columns], "_scan_ranges")
    starts, ends = F.col("_scan_ranges.start"), F.col("_scan_ranges.end")
    # What lies between the ranges: bytes are cut out at their places without a walk over the text.
    between = F.arrays_zip(
        F.concat(F.array(F.lit(0)), ends).alias("a"), F.concat(starts, F.array(F.octet_length("_scan_text"))).alias("b")
    )
    cut = F.transform(
        F.array(F.col("_scan_text").cast("binary")),
        lambda text: F.transform(between, lambda at: F.substr(text, at["a"] + 1, at["b"] - at["a"]).cast("string")),
    )
    marked = F.when(F.col("_scan_ranges").isNotNull(), F.array_join(cut[0], mark)).otherwise(F.col("_scan_text"))
    return rows.withColumn("text", F.when(F.col("text").isNotNull(), marked)).select(*columns)
