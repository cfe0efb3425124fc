"""The operators over their whole tables, each with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import ann, chat, exactdedup, langid, licenses, linededup, mixing, neardup, packing, repair, spelling, suffixes, twofit
from forumlens.llm.common import table
from forumlens.runtime import ship_package

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def shipped(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf)

        ENTRIES[run.__name__] = Entry(shipped, sql)
        return run

    return register


OP1_SQL = r"""
WITH keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
         / CASE WHEN size > 0 AND text IS NOT NULL THEN 1.0::DOUBLE / (1.0::DOUBLE + abs(length(text)::DOUBLE / size - 6.0::DOUBLE) / 6.0::DOUBLE) ELSE 1.0 END AS key
  FROM (SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents)
), sums AS (
  SELECT source, sum(size)::BIGINT AS s FROM keyed GROUP BY source
), weighted AS (
  SELECT source, s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sums
), filled AS (
  SELECT 2.0 * s / w AS full_at, row_number() OVER before AS nth,
         ((SELECT 1.5 * sum(s)::DOUBLE FROM sums) - coalesce(sum(2 * s) OVER capped, 0)::DOUBLE)
         / (sum(w) OVER () - coalesce(sum(w) OVER capped, 0))::DOUBLE AS share
  FROM weighted
  WINDOW before AS (ORDER BY 2.0 * s / w, source NULLS LAST),
         capped AS (ORDER BY 2.0 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min(share, nth) AS share FROM filled WHERE share <= full_at
), planned AS (
  SELECT source, s, least((2 * s)::DOUBLE, share * w) AS target FROM weighted, level
), epochs AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS e FROM planned
), ordered AS (
  SELECT k.doc_id, k.size, p.source, p.s, p.target, p.e, p.target - p.e * p.s AS rest,
         sum(k.size) OVER (PARTITION BY p.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed k JOIN epochs p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size, CAST(target AS DOUBLE) AS target,
       CAST((e + CASE WHEN size > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM ordered
"""


@query(OP1_SQL)
def op1_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op7_pack(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digests(table(spark, sf, "documents"), added=packing.ADDED)


OP8_SQL = r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM norm WINDOW same AS (PARTITION BY t)
"""


@query(OP8_SQL)
def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = exactdedup.classes(table(spark, sf, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query()
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(table(spark, sf, "documents"))


@query()
def op9_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(table(spark, sf, "embeddings"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: one that opens with a license notice is a LICENSE file of its directory."""
    two = F.concat(F.col("source"), F.lit("/d"), F.col("doc_id") % 10)
    three = F.concat(two, F.lit("/e"), F.col("doc_id") % 100)
    level = F.when(F.col("doc_id") % 3 == 0, F.col("source")).when(F.col("doc_id") % 3 == 1, two).otherwise(three)
    opens = F.element_at(F.split("text", "\n"), 1).rlike("(?i)licen")
    path = F.when(opens, F.concat(level, F.lit("/LICENSE"))).otherwise(F.concat(three, F.lit("/"), F.col("doc_id"), F.lit(".txt")))
    return docs.select("doc_id", path.alias("path"), "text")


_TEMPLATES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.TEMPLATES.items())

OP2_SQL = rf"""
WITH templates(license, notice) AS (VALUES {_TEMPLATES}),
template_terms AS (
  SELECT license, term, count(*)::DOUBLE AS tf
  FROM (SELECT license, unnest(regexp_extract_all(lower(notice), '{licenses.TERM}')) AS term FROM templates) GROUP BY ALL
), files AS (
  SELECT doc_id, text,
         CASE WHEN regexp_matches(split_part(text, chr(10), 1), '(?i)licen')
              THEN CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN source || '/d' || (doc_id % 10)
                   ELSE source || '/d' || (doc_id % 10) || '/e' || (doc_id % 100) END || '/LICENSE'
              ELSE source || '/d' || (doc_id % 10) || '/e' || (doc_id % 100) || '/' || doc_id || '.txt' END AS path
  FROM documents
), raw_lines AS (
  SELECT doc_id, path, unnest(range(len(parts))) AS nth, unnest(parts) AS line FROM (SELECT *, string_split(text, chr(10)) AS parts FROM files)
), line_terms AS (
  SELECT doc_id, path, nth, term, count(*)::DOUBLE AS tf
  FROM (SELECT doc_id, path, nth, unnest(regexp_extract_all(lower(line), '{licenses.TERM}')) AS term FROM raw_lines) GROUP BY ALL
), total AS (
  SELECT count(*) AS n FROM (SELECT DISTINCT doc_id, path, nth FROM line_terms)
), vocabulary AS (
  SELECT v.term, ln((1 + (SELECT n FROM total))::DOUBLE / (1 + count(t.term))) AS w
  FROM (SELECT term FROM template_terms UNION SELECT term FROM line_terms) v LEFT JOIN line_terms t ON t.term = v.term GROUP BY v.term
), norms AS (
  SELECT doc_id, path, nth, sqrt(sum(tf * tf * w * w)) AS norm FROM line_terms JOIN vocabulary USING (term) GROUP BY ALL
), template_norms AS (
  SELECT license, sqrt(sum(tf * tf * w * w)) AS norm FROM template_terms JOIN vocabulary USING (term) GROUP BY license
), cosines AS (
  SELECT l.doc_id, l.path, l.nth, t.license, round(sum(l.tf * t.tf * w * w) / any_value(n.norm) / any_value(tn.norm), 6) AS cosine
  FROM line_terms l JOIN template_terms t USING (term) JOIN vocabulary USING (term)
  JOIN norms n ON n.doc_id = l.doc_id AND n.path IS NOT DISTINCT FROM l.path AND n.nth = l.nth JOIN template_norms tn ON tn.license = t.license
  GROUP BY l.doc_id, l.path, l.nth, t.license
), own AS (
  SELECT doc_id, path, arg_min(license, (-cosine, license)) AS license, max(cosine) AS cosine
  FROM cosines WHERE cosine >= {licenses.LEAST_COSINE} GROUP BY ALL
), holding AS (
  SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS up, min((-cosine, path, license)) AS best
  FROM own WHERE path LIKE '%/LICENSE' GROUP BY 1
), passed AS (
  SELECT folder, arg_max(best, length(up)) AS best
  FROM (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM files WHERE path IS NOT NULL)
  JOIN holding ON folder = up OR starts_with(folder, up || '/') GROUP BY folder
)
SELECT f.doc_id, f.path, coalesce(o.license, p.best[3]) AS license, coalesce(o.cosine, -p.best[1]) AS cosine,
       CASE WHEN o.license IS NOT NULL THEN 'own' WHEN p.best IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.license IS NOT NULL THEN f.path ELSE p.best[2] END AS from_path
FROM files f LEFT JOIN own o ON o.doc_id = f.doc_id AND o.path IS NOT DISTINCT FROM f.path
LEFT JOIN passed p ON p.folder = regexp_extract(f.path, '^(.*)/[^/]*$', 1)
"""


@query(OP2_SQL)
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.licensed(document_files(table(spark, sf, "documents")), "doc_id")


SELF_MARKED = "</s>[INST] ok [/INST]"

OP4_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS nth
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{SELF_MARKED}'), (-1, 1, 'assistant', '{SELF_MARKED}'))
), sized AS (
  SELECT *, length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), ']', '&#93;')) AS r,
         length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), ']', '&#93;')) AS t
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth) AS all_turns,
         coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '') AS loss,
         sum(15 + 2 * r + t)::BIGINT AS formatted_chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole
"""


@query(OP4_SQL)
def op4_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", SELF_MARKED), (-1, 1, "assistant", SELF_MARKED)], rows.schema)
    done = chat.branches(chat.by_turn(rows.unionByName(marked)))
    read = done.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("under_loss"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("under_loss").cast("long").alias("loss_chars"), F.sha2("under_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP6_SQL = rf"""
WITH lined AS (
  SELECT page_id, lower(coalesce(regexp_extract(url, '{linededup.HOST}', 1), '')) AS host, row_number() OVER () AS r,
         list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '{linededup.HIDDEN}', '', 'g'), '{linededup.BLOCK}', chr(10), 'g'), '{linededup.TAG}', '', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)),
           lambda l: trim(l, ' ')), lambda l: l != '') AS lines
  FROM pages
), totals AS (
  SELECT host, count(*) AS pages FROM lined GROUP BY host
), drops AS (
  SELECT c.host, list(line) AS gone FROM (
    SELECT host, line, count(*) AS n FROM (SELECT DISTINCT r, host, unnest(lines) AS line FROM lined) GROUP BY ALL
  ) c JOIN totals t ON c.host = t.host WHERE n >= {linededup.LEAST_PAGES} AND n * {linededup.RATIO[1]} > pages * {linededup.RATIO[0]} GROUP BY c.host
), kept AS (
  SELECT page_id, l.host, lines, CASE WHEN gone IS NULL THEN lines ELSE list_filter(lines, lambda l: NOT list_contains(gone, l)) END AS remaining
  FROM lined l LEFT JOIN drops d ON d.host = l.host
)
SELECT page_id, host, len(lines)::INTEGER AS n_lines, (len(lines) - len(remaining))::INTEGER AS n_dropped, array_to_string(remaining, chr(10)) AS text FROM kept
"""


@query(OP6_SQL)
def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return linededup.without_boilerplate(table(spark, sf, "pages"))


@query()
def op3_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    rows = neardup.classes_of(table(spark, sf, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query()
def op10_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf, "documents"))


@query()
def op11_pack_two_fit(spark: SparkSession, sf: str) -> DataFrame:
    return twofit.digests(table(spark, sf, "documents"), added=packing.ADDED)


@query()
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


@query()
def op13_repair_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return repair.report(table(spark, sf, "conversations"))
