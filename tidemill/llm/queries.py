"""One query per operator, over its whole table, and SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.collocations import mine_collocations
from tidemill.llm.common import table
from tidemill.llm.exact_dedup import exact_groups
from tidemill.llm.fill_in_middle import fill_in_middle, restored
from tidemill.llm.fingerprints import edit_fingerprints
from tidemill.llm.html_text import extract_main_text
from tidemill.llm.language_id import identify_language
from tidemill.llm.license_scan import COVERED, NOTICES, PHRASES, scan_licenses
from tidemill.llm.mixing import mix
from tidemill.llm.near_dedup import near_groups
from tidemill.llm.packing import pack_documents
from tidemill.llm.quality import score_quality
from tidemill.llm.token_files import read_documents, write_token_files
from tidemill.llm.toxicity import score_toxicity
from tidemill.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each reading of each document."""
    return mix(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On three-word shingles, at a similarity of 0.85."""
    return near_groups(table(spark, sf_dir, "documents"), width=3, similarity=85)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    text = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    name: query for name, query in list(globals().items()) if name.startswith("op")
}


def _values(templates: dict[str, str]) -> str:
    return ", ".join(f"('{words}', '{label}')" for words, label in templates.items())


_LICENSES = rf"""
    WITH RECURSIVE phrases AS (
        SELECT string_split(p, ' ') AS p, label FROM (VALUES {_values(PHRASES)}) v(p, label)),
    notices AS (
        SELECT row_number() OVER () AS notice, string_split(p, ' ') AS p, label
        FROM (VALUES {_values(NOTICES)}) v(p, label)),
    d AS (
        SELECT row_number() OVER () AS id, doc_id,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    places AS (
        SELECT id, i, w[i + 1 : i + 2] AS two, w[i + 1 : i + 3] AS three, w[i + 1 : i + 4] AS four
        FROM (SELECT id, w, unnest(range(len(w))) AS i FROM d)),
    base AS (SELECT id, i, label FROM places JOIN phrases ON p = CASE len(p) WHEN 2 THEN two ELSE three END),
    grams AS (
        SELECT notice, j, p[j + 1 : j + 4] AS four
        FROM (SELECT notice, p, unnest(range(len(p) - 3)) AS j FROM notices)),
    hits AS (
        SELECT id, notice, min(i) AS first
        FROM (SELECT id, i, notice, i - j AS diagonal FROM places JOIN grams USING (four))
        GROUP BY id, notice, diagonal),
    around AS (
        SELECT DISTINCT id, notice, first, p AS t, w[greatest(first - 64, 0) + 1 : first + 64] AS w
        FROM hits JOIN d USING (id) JOIN notices USING (notice)),
    aligned AS (
        SELECT id, notice, first, t, w, 0 AS k, range(len(t) + 1) AS row, len(t) AS best FROM around
        UNION ALL
        SELECT id, notice, first, t, w, k, row, least(best, row[len(row)])
        FROM (
            SELECT id, notice, first, t, w, k + 1 AS k, best,
                   list_transform(range(len(t) + 1), lambda j: j + list_min(c[1 : j + 1])) AS row
            FROM (
                SELECT *, list_prepend(0, list_transform(range(1, len(t) + 1), lambda j:
                    least(row[j + 1] + 1,
                          row[j] + CASE WHEN t[j] = w[k + 1] THEN 0 ELSE 1 END) - j)) AS c
                FROM aligned WHERE k < len(w)))),
    shares AS (
        SELECT id, notice, first, 1 - min(best) / len(any_value(t)) AS share
        FROM aligned GROUP BY id, notice, first),
    won AS (
        SELECT id, label FROM (
            SELECT *, max(share) OVER (PARTITION BY id, first) AS most FROM shares)
        JOIN notices USING (notice) WHERE share = most AND round(share * 100, 6) >= {COVERED}),
    every AS (SELECT id, label FROM base UNION SELECT id, label FROM won),
    b AS (
        SELECT id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
        FROM base GROUP BY id),
    l AS (SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM every GROUP BY id),
    s AS (SELECT id, max(share) AS share FROM shares GROUP BY id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
    FROM d LEFT JOIN b USING (id) LEFT JOIN l USING (id) LEFT JOIN s USING (id)
"""

ORACLES: dict[str, str] = {
    "op8_license_scan": _LICENSES,
    "op9_minhash_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 1),
                        lambda i: array_to_string(w[i : i + 2], ' '))) END AS s
            FROM d),
        grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM sets),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reached AS (
            SELECT doc_id AS x, doc_id AS y FROM d
            UNION
            SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
        least_of AS (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN least_of USING (doc_id)
    """,
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                       AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op12_collocations": r"""
        WITH texts AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents),
        pieces AS (
            SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                   lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
            FROM w, (SELECT unnest([1, 2, 3]) AS k)),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1 AND f >= 10),
        cuts AS (
            SELECT lang, k, phrase, a, cut, array_to_string(p[1 : cut], ' ') AS head,
                   array_to_string(p[cut + 1 : k], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
        scored AS (
            SELECT cuts.lang, cuts.k, cuts.phrase, a, cut, x.f AS l, y.f AS r,
                   ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head AND x.k = cut
                      JOIN f y ON y.lang = cuts.lang AND y.phrase = tail AND y.k = cuts.k - cut),
        lowest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        covered AS (
            SELECT lang, phrase, max(a) AS longer
            FROM (SELECT lang, a, unnest([array_to_string(p[1 : 2], ' '),
                                          array_to_string(p[2 : 3], ' ')]) AS phrase FROM c WHERE k = 3)
            GROUP BY ALL),
        kept AS (
            SELECT lowest.* FROM lowest LEFT JOIN covered USING (lang, phrase)
            WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, row_number() OVER (
                   PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
    """,
    "op13_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                   sha256('1:' || doc_id) AS h
            FROM documents),
        drawn AS (
            SELECT doc_id, t, u, len(u) AS n,
                   ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1,
                   ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                        WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm'
                        ELSE 'psm' END AS form
            FROM d),
        cut AS (
            SELECT doc_id, n, form, t,
                   array_to_string(list_slice(u, 1, least(c1, c2)), '') AS p,
                   array_to_string(list_slice(u, least(c1, c2) + 1, greatest(c1, c2)), '') AS m,
                   array_to_string(list_slice(u, greatest(c1, c2) + 1, n), '') AS s
            FROM drawn)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                                WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM cut
    """,
}
