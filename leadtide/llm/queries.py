"""Registered queries of the operators and their oracle SQL."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtide.llm import audit, exact, language, lines, mixing, near, order, packing, quality, secret_scan, sharding, toxicity, turns
from leadtide.llm.common import documents


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copies(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(documents(spark, sf_dir)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "source", "block", "slot", "release", "deadline", "place")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(documents(spark, sf_dir)))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "kept")


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return order.materialise(docs, order.fresh_folder(docs))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_digests(turns.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_packing": op3_packing,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_secret_scan": op6_secret_scan,
    "op7_near_dedup": op7_near_dedup,
    "op8_training_order": op8_training_order,
    "op9_quality_rules": op9_quality_rules,
    "op10_language": op10_language,
    "op11_filter_audit": op11_filter_audit,
    "op12_turn_repair": op12_turn_repair,
    "op13_hilbert_shards": op13_hilbert_shards,
}


def _secrets_sql() -> str:
    """Each rule's matches in SQL: pieces between matches and matches, laid end to end."""
    each = []
    for k, r in enumerate(secret_scan.BASE + secret_scan.MORE, 1):
        quoted = r.pattern.replace("'", "''")
        each.append(f"""
SELECT doc_id, {k} AS place, '{r.kind}' AS kind, b AS start, b + length(m[i]) AS stop FROM (
  SELECT doc_id, m, g, i, list_sum(list_transform(p[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS b
  FROM (
    SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, string_split_regex(text, '{quoted}') AS p, regexp_extract_all(text, '{quoted}', 0) AS m,
        regexp_extract_all(text, '{quoted}', {r.group}) AS g
      FROM d
    )
  )
) WHERE length(g[i]) >= {r.least}""")
    counts = ", ".join(f"count(*) FILTER (WHERE place = {k}) AS n_{r.kind}" for k, r in enumerate(secret_scan.BASE, 1))
    said = "string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, place)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(each)}),
n AS (
  SELECT doc_id, {counts}, {said} FILTER (WHERE place <= {len(secret_scan.BASE)}) AS base, {said} AS spans FROM s GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN n USING (doc_id)
"""

def _audit_sql() -> str:
    """Each order of the filters against each combination of failures."""
    letters = ", ".join(f"('{x}')" for x in "ABCDE")
    unlike = " AND ".join(f"{x}.f <> {y}.f" for x, y in combinations("abcde", 2))
    return rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(text, '[ 	-
]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM t
), f AS (
  SELECT doc_id, part, CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM w
), l AS (
  SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
), v(f) AS (VALUES {letters}),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM v a, v b, v c, v d, v e WHERE {unlike}),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
x AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, c.*, contains(fails, substr(filter_order, step, 1)) AS bad,
    len(list_filter(string_split(fails, ''), lambda y: y <> '' AND contains(substr(filter_order, 1, step - 1), y))) > 0 AS out
  FROM c, s
), r AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (WHERE NOT out AND NOT bad), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE bad AND NOT out), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (WHERE bad AND out), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE fails = f), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (WHERE bad AND NOT out), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE bad AND NOT out), 0)::BIGINT AS toxic_lost
  FROM x GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r
"""


#: CRC-32 of a text's UTF-8 in SQL: the table of 256 remainders from its rule, then byte by byte.
CRC_TABLE = """
SELECT list(list_reduce(range(8), lambda a, k: xor(a >> 1, (a & 1) * 3988292384), i) ORDER BY i) AS remainders FROM range(256) r(i)
"""


def crc_sql(text: str, table: str) -> str:
    pairs = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce({pairs}, lambda a, b: xor(a >> 8, {table}[(xor(a, b) & 255) + 1]), 4294967295), 4294967295)"


def _shards_sql() -> str:
    """Bins by rank, the curve's turns one select after the other, then ranks cut into runs."""
    dims, bits = ["lang", "source", "size"], sharding.BITS
    bins = ", ".join(f"((rank() OVER (ORDER BY {d} NULLS FIRST) - 1) * {1 << bits}) // count(*) OVER () AS x{i}" for i, d in enumerate(dims))
    stages, at = [], "b"
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(len(dims)):
            name = f"s{level}_{i}"
            turn = f"CASE WHEN x{i} & {q} <> 0 THEN {q - 1} ELSE xor(x0, x{i}) & {q - 1} END"
            other = f", CASE WHEN x{i} & {q} <> 0 THEN x{i} ELSE xor(x{i}, xor(x0, x{i}) & {q - 1}) END AS x{i}" if i else ""
            stages.append(f"{name} AS (SELECT * REPLACE (xor(x0, {turn}) AS x0{other}) FROM {at})")
            at = name
    twist = "0"
    for level in range(bits - 1, 0, -1):
        twist = f"xor({twist}, CASE WHEN g2 & {1 << level} <> 0 THEN {(1 << level) - 1} ELSE 0 END)"
    curve = " + ".join(
        f"((xor(g{i}, t) >> {level}) & 1) * {1 << (level * len(dims) + len(dims) - 1 - i)}" for level in range(bits) for i in range(len(dims))
    )
    return f"""
WITH c AS ({CRC_TABLE}),
d AS (
  SELECT doc_id, lang, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, {crc_sql("coalesce(text, '')", "remainders")} AS text_crc32
  FROM documents, c
), b AS (SELECT *, {bins} FROM d),
{", ".join(stages)},
g AS (SELECT *, x0 AS g0, xor(x1, x0) AS g1, xor(x2, xor(x1, x0)) AS g2 FROM {at}),
h AS (SELECT *, {twist} AS t FROM g),
k AS (SELECT *, {curve} AS curve FROM h),
r AS (
  SELECT *, row_number() OVER (ORDER BY curve, lang NULLS FIRST, source NULLS FIRST, size, doc_id NULLS FIRST, text_crc32) - 1 AS place, count(*) OVER () AS n
  FROM k
), p AS (SELECT *, (place * {sharding.SHARDS}) // n AS shard FROM r)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INT AS shard,
  (place - (shard * n + {sharding.SHARDS - 1}) // {sharding.SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
FROM p
"""


def _turns_sql() -> str:
    """The cheapest edits from the end, state by state of the grammar; a way is its cost in ten digits and its audit."""

    def step(way: str, cost: str, letter: str) -> str:
        return f"printf('%010d', substr({way}, 1, 10)::BIGINT + {cost}) || '{letter}' || substr({way}, 11)"

    def row(here: str, *after: str) -> str:
        ways = [step(here, "2", "D")]
        for x in after:
            keep = f"CASE WHEN free AND r = '{x}' THEN {step(x, 'more', 'K')} END"
            ways += [keep] if x == "s" else [keep, f"CASE WHEN free AND r <> '{x}' THEN {step(x, 'more + 1', 'R')} END"]
        return f"least({', '.join(ways)})"

    def inserted(u: str, a: str) -> str:
        return (f"least(z, {step(u, '5', 'I')}) AS z, least(s, {step(u, '5', 'I')}) AS s, "
                f"least(u, {step(a, '5', 'I')}) AS u, least(a, {step(u, '5', 'I')}) AS a")  # fmt: skip

    return rf"""
WITH RECURSIVE c AS ({CRC_TABLE}),
d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')", "remainders")} % 20 AS kind
  FROM conversations, c
), x AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS time
  FROM d WHERE kind <> 0
), o AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) AS seen,
    count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS r, left(lag(role) OVER w, 1) || left(role, 1) AS pair
  FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time)
), f AS (
  SELECT *, fault NOT IN ('blank', 'duplicate') AS free, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more FROM (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE '' END AS fault FROM o
  )
), b AS (
  SELECT conv_id, max(n) + 1 AS i, '0000000000' AS z, '0000000010II' AS s, '0000000005I' AS u, '0000000000' AS a FROM f GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, {inserted('u1', 'a1')} FROM (
    SELECT *, least(u, {step('a', '5', 'I')}) AS u1, least(a, {step('u', '5', 'I')}) AS a1 FROM (
      SELECT b.conv_id, f.i, {row('z', 's', 'u')} AS z, {row('s', 'u')} AS s, {row('u', 'a')} AS u, {row('a', 'u')} AS a
      FROM b JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i - 1
    )
  )
), best AS (SELECT conv_id, substr(z, 1, 10)::BIGINT AS cost, substr(z, 11) AS audit FROM b WHERE i = 1),
l AS (
  SELECT conv_id, k, letter, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w AS place
  FROM (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS k, substr(audit, k, 1) AS letter FROM best)
  WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), m AS (
  SELECT l.*, f.role, f.text, bool_or(letter = 'K' AND f.r = 's') OVER (PARTITION BY l.conv_id) AS system
  FROM l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND letter <> 'I'
), t AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place + coalesce(system, false)::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS said
  FROM m WHERE letter <> 'D' GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
)
SELECT e.conv_id, {", ".join(f"coalesce({x}, 0)::BIGINT AS {x}" for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))},
  coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLES = {
    "op1_line_dedup": r"""
WITH l AS (
  SELECT doc_id, source, trim(unnest(string_split(text, chr(10))), E' \t\r\x0b\x0c') AS line FROM documents
), b AS (
  SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10
), d AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls, coalesce((SELECT list(line) FROM b), []) AS bad FROM documents
), k AS (
  SELECT doc_id, ls, list_filter(ls, lambda s: NOT list_contains(bad, trim(s, E' \t\r\x0b\x0c'))) AS kept FROM d
)
SELECT doc_id, array_to_string(kept, chr(10)) AS text, coalesce(len(ls), 0) AS n_lines, coalesce(len(ls) - len(kept), 0) AS n_removed FROM k
""",
    "op2_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) AS place,
    first_value(doc_id) OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM r
""",
    "op4_mixing": """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(length(text), 0) AS size, ('0x' || md5(doc_id::VARCHAR)[1:8])::BIGINT AS h FROM documents
), src AS (
  SELECT source, CASE WHEN source = 'src0' THEN 4 ELSE 1 END AS share, greatest(1, ceil(sum(size) / 50000))::BIGINT AS blocks
  FROM d GROUP BY source
), lives AS (SELECT *, ceil(blocks / share)::BIGINT AS life FROM src),
ends AS (SELECT life AS to_p, coalesce(lag(life) OVER (ORDER BY life), 0) AS from_p FROM (SELECT DISTINCT life FROM lives)),
p AS (
  SELECT from_p, to_p, list(source ORDER BY source) AS names, list(share ORDER BY source) AS shares, sum(share)::BIGINT AS slots
  FROM ends JOIN lives ON life > from_p GROUP BY ALL
), based AS (
  SELECT *, coalesce(sum((to_p - from_p) * slots) OVER (ORDER BY from_p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM p
), r AS (
  SELECT from_p, 0 AS t, list_transform(shares, lambda x: 0) AS done, NULL::STRUCT(deadline BIGINT, i BIGINT, j BIGINT, release BIGINT) AS b FROM p
  UNION ALL
  SELECT from_p, t + 1, list_transform(done, lambda x, i: x + (i = b.i)::INT), b FROM (
    SELECT r.from_p, r.t, r.done, list_sort(list_filter(list_transform(r.done, lambda x, i:
      CASE WHEN x < p.shares[i] AND floor(x * p.slots / p.shares[i]) <= r.t THEN {
        'deadline': ceil((x + 1) * p.slots / p.shares[i])::BIGINT, 'i': i::BIGINT, 'j': x::BIGINT,
        'release': floor(x * p.slots / p.shares[i])::BIGINT} END), lambda y: y IS NOT NULL))[1] AS b
    FROM r JOIN p USING (from_p) WHERE r.t < p.slots
  )
), s AS (
  SELECT from_p, to_p, base, slots, names[b.i] AS source, b.j AS j, t - 1 AS slot, b.release AS release, b.deadline AS deadline
  FROM r JOIN based USING (from_p) WHERE t > 0
), placed AS (
  SELECT doc_id, source, share, blocks,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM d JOIN lives USING (source)
), o AS (SELECT *, least(place // 50000, blocks - 1) AS block FROM placed)
SELECT doc_id, source, block, base + (block // share - from_p) * slots + slot AS slot, base + (block // share - from_p) * slots + release AS release,
  base + (block // share - from_p) * slots + deadline AS deadline, place
FROM o JOIN s USING (source) WHERE block % share = j AND block // share >= from_p AND block // share < to_p
""",
    "op6_secret_scan": _secrets_sql(),
    "op11_filter_audit": _audit_sql(),
    "op12_turn_repair": _turns_sql(),
    "op13_hilbert_shards": _shards_sql(),
    "op9_quality_rules": r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), p AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM t)
), q AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM p) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM q, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id
), m AS (
  SELECT t.doc_id, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN c USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (
  SELECT source, rule, count(*) AS n, sum(bad::INT) AS failed FROM (
    SELECT source, 'base' AS rule, base_failed AS bad FROM b
    UNION ALL SELECT source, 'symbols', n_symbols * 10 > n_words FROM b
    UNION ALL SELECT source, 'lines', n_dup_lines * 3 > n_lines FROM b
    UNION ALL SELECT source, 'length', word_chars > 12 * n_words OR word_chars < 2 * n_words FROM b
  ) GROUP BY 1, 2
), prior AS (
  SELECT rule, avg(failed / n) AS m, var_pop(failed / n) AS v,
    CASE WHEN var_pop(failed / n) > 0 THEN avg(failed / n) * (1 - avg(failed / n)) / var_pop(failed / n) - 1 ELSE 1 END AS strength
  FROM h GROUP BY rule
), bad AS (
  SELECT source, max((failed + m * strength) / (n + strength)) > 0.5 AS host_rejected
  FROM h JOIN prior USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_rejected AS kept
FROM b JOIN bad ON b.source IS NOT DISTINCT FROM bad.source
""",
}
