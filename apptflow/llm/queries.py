"""The registered queries of the operators: thin digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptflow.llm import (
    decontaminate,
    embeddings,
    extract,
    language,
    lines,
    packing,
    periodic,
    pii,
    quality,
    resample,
    simhash,
    substrings,
    toxicity,
)
from apptflow.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.grade(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    held = language.held_out("doc_id").alias("held_out")
    return found.select("doc_id", held, "expected_grade", "tail_prob", "selected")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymize(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        language.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(table(spark, sf_dir, "documents"), plant=True)
    runs = F.arrays_zip(
        F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period")
    )
    line = F.transform(
        runs,
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    # longest first, then smallest start and period
    keys = F.transform(
        runs,
        lambda r: F.struct(
            r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
        ),
    )
    found = found.withColumn("_best", F.array_max(keys))
    period = -F.col("_best.period")
    return found.select(
        "doc_id",
        F.size("starts").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * F.col("_best.length") / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_language": op3_language,
    "op4_substrings": op4_substrings,
    "op5_embeddings": op5_embeddings,
    "op6_extract": op6_extract,
    "op7_quality": op7_quality,
    "op8_pii": op8_pii,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_resampling": op11_resampling,
    "op12_periodic": op12_periodic,
    "op13_lines": op13_lines,
}

#: CRC-32 of a text, byte by byte, with a table made from its rule
_CRC = """
crc_bits AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        list_prepend(b, range(8)),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS of_byte
),"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+')"

#: queries that SQL can express
ORACLE: dict[str, str] = {
    "op2_decontamination": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS win
    FROM (SELECT item_id, words, least(10, len(words)) AS size,
                 unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
          FROM items WHERE len(words) > 0)
),
hits AS (
    SELECT d.doc_id, d.i, d.size, w.item_id
    FROM (SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS win
          FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
                FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(words) >= size)) d
    JOIN item_windows w ON w.size = d.size AND w.win = d.win
),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
),
listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN listed l ON l.doc_id = d.doc_id
""",
    "op4_substrings": """
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x{20}\\x{09}-\\x{0D}]+') AS words FROM documents
),
windows AS (
    SELECT doc_id, i, sha256(array_to_string(words[i : i + 49], ' ')) AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs WHERE len(words) >= 50)
),
late AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS low FROM windows) WHERE low < doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM late),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM docs),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
    FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
""",
    "op11_resampling": f"""
WITH {_CRC}
texts AS (
    SELECT 'd' AS side, doc_id AS id, {_WORDS} AS words FROM documents
    UNION ALL
    SELECT 'b', item_id, {_WORDS} FROM benchmark
),
features AS (
    SELECT side, id, array_to_string(words[i : i + k], ' ') AS feature
    FROM (SELECT side, id, words, unnest(range(1, len(words) + 1)) AS i FROM texts), range(0, 3) AS r(k)
    WHERE i + k <= len(words)
),
buckets AS (
    SELECT feature, xor(list_reduce(
        list_prepend(4294967295, list_transform(
            range(len(hex(encode(feature))) // 2),
            lambda j: ('0x' || substr(hex(encode(feature)), 2 * j + 1, 2))::BIGINT)),
        lambda c, x: xor(c >> 8, of_byte[xor(c % 256, x) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM features), crc_bits
),
placed AS (SELECT side, id, bucket FROM features JOIN buckets USING (feature)),
totals AS (
    SELECT count(*) FILTER (side = 'd') AS of_docs, count(*) FILTER (side = 'b') AS of_items FROM placed
),
gains AS (
    SELECT bucket, floor(1000 * ln(
        (count(*) FILTER (side = 'b') + 1)::DOUBLE * (any_value(of_docs) + 10000)
        / ((count(*) FILTER (side = 'd') + 1)::DOUBLE * (any_value(of_items) + 10000))))::BIGINT AS gain
    FROM placed, totals GROUP BY bucket
),
weights AS (
    SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
),
scored AS (
    SELECT t.id AS doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
        coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('42:' || t.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM texts t LEFT JOIN weights w ON t.id = w.id WHERE t.side = 'd'
),
able AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_words >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN able a ON s.doc_id = a.doc_id
""",
    "op13_lines": """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
common AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
    SELECT doc_id, place, line, coalesce(doc_id < last, false) AS dropped FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
