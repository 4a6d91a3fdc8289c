"""Secret scan through a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived: an AND of ORs of ANDs that any match must
satisfy. Postings (text, trigram) are kept for the trigrams that some query names; intersecting them leaves the candidates,
which the expression itself then verifies. A rule without mandatory trigrams scans every text.

Postings and findings are keyed by the text's digest, so copies share one verification. A finding's span is the whole
match, in code points, end exclusive; matches are leftmost and do not overlap within a kind; those whose checked
group is too short are dropped after matching.

Defined cases: a null or empty text has no findings; repeated rows come back as often as they came in; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import literal_rows, staged, text_or_empty

try:
    from re import _constants as sre
    from re import _parser as sre_parser
except ImportError:  # Python before 3.11
    import sre_constants as sre
    import sre_parse as sre_parser


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0


#: Fixed patterns. A maximal run of 24 or more is what remains of all runs when the shorter are dropped.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
_MOST = 8  # alternatives that a literal stretch may have


def _literals(node) -> set[str] | None:
    """The strings that a parsed item can match, where they are few; else None."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN and all(k is sre.LITERAL for k, _ in arg):
        return {chr(v) for _, v in arg} if len(arg) <= _MOST else None
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] == 1 and arg[0] == 0:
        inner = _sequence(arg[2])
        return None if inner is None else inner | {""}
    return None


def _sequence(items) -> set[str] | None:
    out = {""}
    for item in items:
        got = _literals(item)
        if got is None or len(out) * len(got) > _MOST:
            return None
        out = {a + b for a in out for b in got}
    return out


def _stretches(items) -> list[set[str]]:
    """What any match must contain, stretch by stretch: each a set of strings of which one occurs."""
    out, run = [], {""}
    for item in items:
        got = _literals(item)
        if got is not None and len(run) * len(got) <= _MOST:
            run = {a + b for a in run for b in got}
            continue
        out.append(run)
        run = got if got is not None else {""}
        if got is None and item[0] is sre.SUBPATTERN:  # no literal itself, but it may hold some
            out += _stretches(item[1][-1])
    return [*out, run]


def trigram_query(pattern: str) -> list[list[set[str]]]:
    """AND over stretches, OR over a stretch's strings, AND over a string's trigrams (lower-cased).
    Empty where no match needs a trigram."""
    out = []
    for strings in _stretches(sre_parser.parse(pattern)):
        grams = [{s.lower()[i:i + 3] for i in range(len(s) - 2)} for s in strings]
        if all(grams):
            out.append(grams)
    return out


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(key, trigram): which of ``trigrams`` each text holds; ``texts`` has key and text."""
    wanted = F.array(*[F.lit(t) for t in trigrams])
    # the lower-cased text is bound once, as an element, and looked through for each trigram
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))
    return texts.select("key", F.explode(F.flatten(held)).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): texts whose postings satisfy the query of each of these rules."""
    spark, rows = index.sparkSession, []
    for r in rules:
        query = trigram_query(r.pattern)
        for n, strings in enumerate(query):
            for alt, grams in enumerate(strings):
                rows += [(r.kind, n, alt, t, 1 << i, (1 << len(grams)) - 1, len(query)) for i, t in enumerate(sorted(grams))]
    # one row per trigram of the rules
    asked = literal_rows(spark, rows, "kind string, stretch long, alt long, trigram string, bit long, need long, stretches long")
    found = index.join(F.broadcast(asked), "trigram").groupBy("key", "kind", "stretch", "alt", "need", "stretches").agg(F.bit_or("bit").alias("has"))
    met = found.where("has = need").groupBy("key", "kind", "stretches").agg(F.bit_or(F.expr("shiftleft(1L, CAST(stretch AS INT))")).alias("met"))
    return met.where("met = shiftleft(1L, CAST(stretches AS INT)) - 1").groupBy("key").agg(F.collect_set("kind").alias("rules"))


def _matches(texts: DataFrame, rule: Rule) -> DataFrame:
    """(key, kind, start, end): the rule's matches; ``texts`` has one row per key.

    The text between matches comes from split, the matches from regexp_extract_all; running lengths give the places."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(F.split("text", rule.pattern, -1).alias("gap"),
                         F.regexp_extract_all("text", pattern, F.lit(0)).alias("whole"),
                         F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("value"))
    each = texts.where(F.array_contains("rules", rule.kind)).select("key", F.posexplode(parts).alias("n", "p"))
    each = each.select("key", "n", F.char_length("p.gap").alias("gap"), F.char_length("p.whole").alias("whole"), F.char_length("p.value").alias("value"))
    upto = Window.partitionBy("key").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.coalesce("whole", F.lit(0))).over(upto)
    return each.withColumn("end", end).where(F.col("whole").isNotNull() & (F.col("value") >= rule.min_chars)).select(
        "key", F.lit(rule.kind).alias("kind"), (F.col("end") - F.col("whole")).alias("start"), "end")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """The findings (key, kind, start, end) of each different text, and (doc_id, key) of the documents."""
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("key", F.md5(F.col("text").cast("binary")))
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    scanned = tuple(r for r in rules if r not in indexed)
    grams = sorted({t for r in indexed for strings in trigram_query(r.pattern) for g in strings for t in g})
    index = staged(postings(texts, grams), "secret-postings")
    chosen = candidates(index, indexed).withColumnRenamed("key", "chosen")
    hit = F.array_compact(F.array(*[F.when(F.col("text").rlike(r.pattern), F.lit(r.kind)) for r in scanned], F.lit(None).cast("string")))
    joined = texts.select("key", "text", hit.alias("scanned")).join(chosen, F.col("key") == F.col("chosen"), "left")
    joined = joined.select("key", "text", F.concat("scanned", F.coalesce("rules", F.array().cast("array<string>"))).alias("rules"))
    verify = staged(joined.where(F.size("rules") > 0).dropDuplicates(["key"]), "secret-candidates")
    found = None
    for r in rules:
        got = _matches(verify, r)
        found = got if found is None else found.unionByName(got)
    return found, texts.select("doc_id", "key")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[str, ...] = ("assign", "access", "hex")) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found, names = find_secrets(docs, rules)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    spans = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", order[F.col("kind")].alias("rank"), "kind", "end"))).alias("spans"))
    # written first, so that adaptive execution may split the join at a text that a third of the documents share
    rows = names.join(staged(spans, "secret-spans"), "key", "left")
    spans = F.coalesce(F.col("spans"), F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>"))
    own = F.filter(spans, lambda s: s["kind"].isin(*base))

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in base]
    return rows.select("doc_id", *counts, F.sha2(_listed(own), 256).alias("base_sha256"), _listed(spans).alias("spans"))


