"""One thin query per operator of this folder, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.llm.common import crc_mod, table
from rosterforge.llm.decontaminate import contaminated
from rosterforge.llm.langid import fit_langid, predict_languages
from rosterforge.llm.minhash import minhash_components
from rosterforge.llm.mixture import mix_sources
from rosterforge.llm.neighbours import nearest_neighbours
from rosterforge.llm.phrases import mine_phrases
from rosterforge.llm.pii import find_pii, fit_pii
from rosterforge.llm.secrets import find_secrets, identifier_dictionary
from rosterforge.llm.simhash import simhash_components
from rosterforge.llm.substrings import remove_repeats
from rosterforge.llm.survival import filter_audit
from rosterforge.llm.toxicity import fit_toxicity, score_toxicity
from rosterforge.llm.warc import archive_round_trip


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_fold", crc_mod("doc_id", 4))
    model = fit_langid(docs.filter("_fold <> 2"))
    found = predict_languages(docs, model)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_mod("doc_id", 5)
    model = fit_toxicity(docs.filter(fold != 0), table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).drop("url")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_secrets(docs, identifier_dictionary(docs))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_pii(docs, fit_pii(docs)).drop("redacted")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix_sources(docs, carry=("doc_id", "source", "lang")).select(
        "row.doc_id", "row.source", "row.lang", "topic", "tokens", "probability", "weight", "sampled"
    )


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_neighbours": op4_neighbours,
    "op5_secrets": op5_secrets,
    "op6_pii": op6_pii,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_repeated_substrings": op8_repeated_substrings,
    "op9_decontaminate": op9_decontaminate,
    "op10_mixture": op10_mixture,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_phrases": op12_phrases,
    "op13_filter_audit": op13_filter_audit,
}
ORACLE: dict[str, str] = {
    "op3_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first_id < page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op11_minhash_dedup": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
            ), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws
                ELSE list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) END AS shingles
            FROM w
        ), classes AS (
            SELECT min(doc_id) AS cls, any_value(list_sort(shingles)) AS shingles, len(any_value(shingles)) AS n
            FROM sets WHERE len(shingles) > 0 GROUP BY list_sort(shingles)
        ), postings AS (
            SELECT cls, n, unnest(shingles) AS shingle FROM classes
        ), links AS (
            SELECT a.cls AS x, b.cls AS y FROM postings a JOIN postings b ON a.shingle = b.shingle AND a.cls < b.cls
                AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), both_ways AS (
            SELECT x, y FROM links UNION ALL SELECT y, x FROM links
        ), reached AS (
            SELECT cls AS node, cls AS root FROM classes
            UNION
            SELECT y, root FROM reached JOIN both_ways ON node = x AND root < y
        ), roots AS (
            SELECT node, min(root) AS root FROM reached GROUP BY node
        ), named AS (
            SELECT shingles, root FROM classes JOIN roots ON cls = node
        )
        SELECT doc_id, coalesce(len(s.shingles), 0) AS n_shingles, coalesce(root, doc_id) AS component_id,
            doc_id = coalesce(root, doc_id) AS kept
        FROM sets s LEFT JOIN named ON list_sort(s.shingles) = named.shingles
    """,
    "op12_phrases": """
        WITH pieces AS (
            SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \\t]+') IF w <> ''] AS ws FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
                    text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
                ), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
            )
        ), places AS (
            SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces
        ), f1 AS (
            SELECT lang, ws[i] AS u, count(*) AS f FROM places GROUP BY ALL
        ), f2 AS (
            SELECT lang, ws[i] AS u, ws[i + 1] AS v, count(*) AS f FROM places WHERE i + 1 <= len(ws) GROUP BY ALL
            HAVING count(*) >= 10
        ), f3 AS (
            SELECT lang, ws[i] AS u, ws[i + 1] AS v, ws[i + 2] AS w, count(*) AS f FROM places WHERE i + 2 <= len(ws)
            GROUP BY ALL HAVING count(*) >= 10
        ), longer AS (
            SELECT lang, u, v, max(f) AS most FROM (
                SELECT lang, u, v, f FROM f3 UNION ALL SELECT lang, v, w, f FROM f3
            ) GROUP BY ALL
        ), cuts AS (
            SELECT f2.lang, f2.u || ' ' || f2.v AS phrase, f2.f AS a, x.f AS l, y.f AS r, 1 AS k
            FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.u = f2.u JOIN f1 y ON y.lang = f2.lang AND y.u = f2.v
            LEFT JOIN longer ON longer.lang = f2.lang AND longer.u = f2.u AND longer.v = f2.v
            WHERE coalesce(100 * most < 50 * f2.f, true)
            UNION ALL
            SELECT f3.lang, f3.u || ' ' || f3.v || ' ' || f3.w, f3.f, x.f, y.f, 1
            FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.u = f3.u
            JOIN f2 y ON y.lang = f3.lang AND y.u = f3.v AND y.v = f3.w
            UNION ALL
            SELECT f3.lang, f3.u || ' ' || f3.v || ' ' || f3.w, f3.f, x.f, y.f, 2
            FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.u = f3.u AND x.v = f3.v
            JOIN f1 y ON y.lang = f3.lang AND y.u = f3.w
        ), scored AS (
            SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
        ), weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
            phrase, a, l, r, n, score
        FROM weakest JOIN totals USING (lang)
        QUALIFY rank <= 2000
    """,
    "op13_filter_audit": """
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents
        ), flags AS (
            SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS bad
            FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
        ), judged AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, [
                len(words) < 200,
                100 * len(list_distinct(words)) < 50 * len(words),
                100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
                regexp_matches(t, '[#$%&*|]'),
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)
            ] AS fails
            FROM d LEFT JOIN flags USING (doc_id)
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
        ), orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ), steps AS (
            SELECT filter_order, step, filter_order[step] AS f,
                [ord(x) - 64 FOR x IN string_split(filter_order[:step - 1], '') IF x <> ''] AS earlier
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
        ), patterns AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM judged GROUP BY ALL
        ), met AS (
            SELECT part, filter_order, step, f, n, good, bad, fails[ord(f) - 64] AS own,
                len([x FOR x IN earlier IF fails[x]]) > 0 AS gone, len([x FOR x IN fails IF x]) AS failed
            FROM patterns, steps
        ), counted AS (
            SELECT part, filter_order, step, f,
                sum(n) FILTER (NOT gone AND NOT own) AS kept, sum(n) FILTER (NOT gone AND own) AS removed,
                sum(n) FILTER (gone AND own) AS redundant, sum(n) FILTER (own AND failed = 1) AS unique_fails,
                sum(good) FILTER (NOT gone AND own) AS good_lost, sum(bad) FILTER (NOT gone AND own) AS toxic_lost
            FROM met GROUP BY ALL
        )
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
            coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
            coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
            coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
        FROM counted
    """,
}
