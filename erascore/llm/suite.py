"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them.

Each query applies its operator, with production parameters, to its whole table; digests are derived here from the
operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import alignment, chat, codebooks, dartminhash, decontam, licenses, linededup, packing, rules, secrets, simhash, urls, warc
from .common import literal_rows, prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Vocabulary of the packing query (a file of the installed ``public_tokenizers``).
TOKENIZER = "word_bpe_49k.json"
#: Vocabularies of the alignment query.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def control_example(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are control strings of a common template."""
    said = "</s>[INST] ok [/INST]"
    return literal_rows(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), e AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'), '(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g'))
          + length(regexp_replace(replace(role, '\', '\\'), '(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g'))
          + length('<|im_start|><|im_sep|><|im_end|>') AS chars FROM c
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@register("op1_chat_formatting", OP1_SQL)
def op1(spark, sf):
    rows = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(control_example(spark))
    rows = rows.withColumn("conv_id", F.struct("conv_id"))  # rows without an id are one conversation too
    formatted = chat.format_trees(chat.chain_of_turns(rows), top=1)
    back = formatted.select("tree", "formatted", "loss_spans", chat.parse(F.col("formatted")).alias("turns"))
    back = back.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("tree.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


@register("op2_packing")
def op2(spark, sf):
    return packing.with_crc(packing.pack(read_table(spark, sf, "documents").select("doc_id", "text"), tokenizer_path(), keep_ids=False))


@register("op3_dartminhash")
def op3(spark, sf):
    return dartminhash.near_duplicates(read_table(spark, sf, "documents").select("doc_id", "text"))


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.rid, k.line, k.i, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key),
g AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY rid)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, kept_sha256 FROM g JOIN d USING (rid)"""


@register("op4_line_dedup", OP4_SQL)
def op4(spark, sf):
    return linededup.line_report(read_table(spark, sf, "documents").select("doc_id", "text"))


@register("op5_decontamination")
def op5(spark, sf):
    return decontam.contaminated(read_table(spark, sf, "documents").select("doc_id", "text"), read_table(spark, sf, "benchmark"))


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, unnest(list_transform(range(1, CAST(len(ws) - 6 AS BIGINT)), lambda i: {'i': i, 's': array_to_string(ws[i:i + 7], ' ')})) AS x
      FROM w WHERE len(ws) >= 8),
o AS (SELECT rid, x.i AS i, count(*) OVER (PARTITION BY rid, x.s) AS n FROM g),
c AS (SELECT rid, count(DISTINCT p) AS n_repeat FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM o WHERE n > 1) GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
q AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(t, '[^a-z]', '', 'g')) AS low,
        (SELECT count(*) FROM l WHERE l.rid = w.rid AND regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_lines
      FROM w LEFT JOIN c USING (rid) LEFT JOIN q USING (rid)),
b AS (SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 8 ELSE 0 END
        + CASE WHEN up + low > 0 AND 2 * up > up + low THEN 16 ELSE 0 END
        + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, (bits & 31) = 0 AS kept,
       CAST(bits AS BIGINT) AS fail_bits FROM b"""


@register("op6_quality_rules", OP6_SQL)
def op6(spark, sf):
    return rules.quality_report(read_table(spark, sf, "documents").select("doc_id", "text"))


_RULE_SQL = " UNION ALL ".join(
    f"SELECT '{p.name}/{p.version}' AS policy, '{r}' AS rule, CAST(count(*) FILTER (WHERE fail_bits & {bit} <> 0) AS BIGINT) AS failed, "
    f"CAST(count(*) FILTER (WHERE fail_bits & {p.mask} = {bit}) AS BIGINT) AS alone FROM q"
    for p in (rules.BASE, rules.STANDARD, rules.STRICT) for r in p.rules for bit in [1 << [n for n, _ in rules.RULES].index(r)])


@register("quality_ablation", f"WITH q AS ({OP6_SQL}) {_RULE_SQL}")
def quality_ablation(spark, sf):
    """What each rule of three policies rejects, and alone rejects, from one written ledger."""
    return rules.ablations(rules.written_ledger(read_table(spark, sf, "documents").select("doc_id", "text")), (rules.BASE, rules.STANDARD, rules.STRICT))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
d AS (SELECT page_id, payload_bytes, sha256(html) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM m"""


@register("op7_warc", OP7_SQL)
def op7(spark, sf):
    return warc.page_report(read_table(spark, sf, "pages"))


def _op8_sql() -> str:
    parts = []
    for i, r in enumerate(secrets.RULES):
        pat = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT rid, {i} AS rank, '{r.kind}' AS kind, end_at - length(whole) AS start_at, end_at, length(value) AS n, {r.min_chars} AS least FROM (
    SELECT rid, whole, value, sum(length(gap) + length(coalesce(whole, ''))) OVER (PARTITION BY rid ORDER BY i) AS end_at FROM (
      SELECT rid, unnest(string_split_regex(t, '{pat}')) AS gap, unnest(regexp_extract_all(t, '{pat}', 0)) AS whole,
             unnest(regexp_extract_all(t, '{pat}', {r.group})) AS value, unnest(range(0, len(string_split_regex(t, '{pat}')))) AS i
      FROM d WHERE regexp_matches(t, '{pat}'))) WHERE whole IS NOT NULL""")
    text = "kind || ':' || CAST(start_at AS BIGINT) || ':' || CAST(end_at AS BIGINT)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n >= least),
g AS (SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS b, count(*) FILTER (WHERE kind = 'hex') AS c,
        string_agg({text}, ',' ORDER BY start_at, rank) FILTER (WHERE rank < 3) AS base, string_agg({text}, ',' ORDER BY start_at, rank) AS spans FROM s GROUP BY rid)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access, CAST(coalesce(c, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)"""


@register("op8_secret_scan", _op8_sql())
def op8(spark, sf):
    return secrets.secret_report(read_table(spark, sf, "documents").select("doc_id", "text"))


OP9_SQL = r"""
WITH RECURSIVE u AS (SELECT row_number() OVER () AS rid, page_id, url, html FROM pages),
n AS (SELECT rid AS src, url AS link FROM u
      UNION ALL
      SELECT -rid, regexp_extract(unnest(regexp_extract_all(coalesce(html, ''),
        '(?is)<(?:link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*|meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*)>')),
        '(?i)(?:href\s*=\s*["'']?|url\s*=\s*)([a-z][a-z0-9+.-]*://[^"''\s>]+)', 1) FROM u),
s AS (SELECT src, CASE WHEN contains(link, '://') THEN regexp_replace(link, '(?s)^.*?://', '') ELSE '' END AS rest,
             regexp_extract(link, '(?s)^(.*?)://', 1) AS scheme FROM n),
h AS (SELECT src, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail,
             translate(scheme, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS scheme FROM s),
j AS (SELECT src, host, path, CASE WHEN host <> '' THEN scheme || '://' || host || CASE WHEN tail = '' THEN '/' ELSE tail END END AS node,
        CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
             WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
             WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM h),
v AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS own FROM j),
e AS (SELECT DISTINCT a.node AS a, b.node AS b FROM v a JOIN v b ON b.src = -a.src AND a.src > 0 WHERE a.node <> b.node),
r(a, b) AS (SELECT DISTINCT node, node FROM v WHERE node IS NOT NULL
      UNION SELECT r.a, x.b FROM r JOIN (SELECT a, b FROM e UNION SELECT b, a FROM e) x ON r.b = x.a),
p AS (SELECT r.a AS node, CASE WHEN bool_or(v.own = 'allow') THEN 'allow' WHEN bool_or(v.own = 'block') THEN 'block' ELSE 'allow' END AS spread
      FROM r JOIN v ON r.b = v.node GROUP BY r.a)
SELECT page_id, host, path, rule, coalesce(own, spread, 'allow') AS verdict
FROM u JOIN v ON v.src = u.rid LEFT JOIN p ON p.node = v.node"""


@register("op9_url_filter", OP9_SQL)
def op9(spark, sf):
    return urls.url_report(read_table(spark, sf, "pages"))


def _op10_sql() -> str:
    def canonical(text: str) -> str:
        pattern = licenses._COPYRIGHT.replace("(?md)", "(?m)")
        out = f"regexp_replace(regexp_replace(lower({text}), '\\r\\n?', chr(10), 'g'), '{pattern}', '', 'g')"
        out = f"('  ' || regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || '  ')"
        for spelled, kept in licenses.SPELLINGS:
            out = f"replace({out}, ' {spelled} ', ' {kept} ')"
        return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"

    quoted = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licenses.KNOWN)
    return f"""
WITH k AS (SELECT sha256({canonical('t')}) AS digest, min(id) AS license_id FROM (VALUES {quoted}) AS v(id, t) GROUP BY 1),
d AS (SELECT doc_id, {canonical("coalesce(text, '')")} AS c FROM documents)
SELECT doc_id, CAST(length(c) AS BIGINT) AS canonical_chars, sha256(c) AS canonical_sha256, license_id
FROM d LEFT JOIN k ON sha256(c) = k.digest AND length(c) > 0"""


@register("op10_license_scan", _op10_sql())
def op10(spark, sf):
    return licenses.license_report(read_table(spark, sf, "documents").select("doc_id", "text"))


@register("op11_simhash")
def op11(spark, sf):
    return simhash.near_duplicates(read_table(spark, sf, "documents").select("doc_id", "text"))


def _op12_sql() -> str:
    """The rounds unrolled: plain Lloyd, which the operator's rounds must equal."""
    parts = codebooks.PARTS
    steps = []
    for turn in range(codebooks.ROUNDS + 1):
        # the nearest entry: the least distance, then the lower index
        steps.append(f"""a{turn} AS MATERIALIZED (SELECT x.rid, x.part, any_value(x.v) AS v,
    min(struct_pack(d := CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), e := c.entry)) AS best
  FROM x JOIN c{turn} c ON c.part = x.part GROUP BY x.rid, x.part)""")
        if turn < codebooks.ROUNDS:
            steps.append(f"""s{turn} AS (SELECT part, best.e AS entry, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT part, best, v, unnest(range(1, len(v) + 1)) AS i FROM a{turn}) GROUP BY ALL),
m{turn} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{turn} GROUP BY ALL),
c{turn + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{turn} c LEFT JOIN m{turn} m USING (part, entry))""")
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    list_transform(embedding, lambda y: CAST(floor(CAST(y AS DOUBLE) * {codebooks.SCALE}) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (SELECT rid, part, w[part * (len(w) // {parts}) + 1:(part + 1) * (len(w) // {parts})] AS v FROM k, range({parts}) AS r(part)),
c0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, v FROM x WHERE rid <= {codebooks.ENTRIES}),
{", ".join(steps)},
o AS (SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{codebooks.ROUNDS} GROUP BY rid),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{codebooks.ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o JOIN k USING (rid), h"""


@register("op12_vector_codes", _op12_sql())
def op12(spark, sf):
    return codebooks.code_report(read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))


@register("op13_token_alignment")
def op13(spark, sf):
    return alignment.alignment_report(read_table(spark, sf, "documents").select("doc_id", "text"), *map(tokenizer_path, ALIGNED))
