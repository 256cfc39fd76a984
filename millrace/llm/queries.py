"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, extraction, language, licenses, pii, quality_rules
from millrace.llm.decontaminate import contained_items
from millrace.llm.importance import resampled
from millrace.llm.lexical_search import ranked
from millrace.llm.license_rules import signatures
from millrace.llm.line_dedup import without_shared_lines
from millrace.llm.near_dedup import near_duplicates
from millrace.llm.token_files import read_token_file, write_token_file
from millrace.llm.vector_codes import vector_codes, with_label_error
from millrace.session import working_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language, score and acceptance of every document; a third of them is never learned from."""
    documents = _table(spark, folder, "documents")
    sample = language.labelled_sample(documents.where(~_held_out()))
    identify = language.language_of(language.train(sample))
    found = documents.select("doc_id", identify(F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        _held_out().alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.accepted").alias("accepted"),
    )


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups on three words and a similarity of 0.85."""
    return near_duplicates(_table(spark, folder, "documents"), shingle_words=3, percent=85)


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the base kinds and all spans of personal data of every document."""
    spans = pii.with_spans(_table(spark, folder, "documents").select("doc_id", "text"), "spans")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(pii.BASE_KINDS))
    return spans.select(
        "doc_id",
        *(count(kind) for kind in pii.BASE_KINDS),
        F.sha2(pii.described(base), 256).alias("base_sha256"),
        pii.described(F.col("spans")).alias("spans"),
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that contains a benchmark item, with the item and what they share."""
    documents, benchmark = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return contained_items(documents, benchmark, short_inside=True)


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and the bytes that they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.with_ids(documents, path, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    extract = extraction.extractor(extraction.default_field())
    pages = _table(spark, folder, "pages").select("page_id", "url", extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and the verdict of base checks and rule cascade for every document."""
    texts = _table(spark, folder, "documents").select("doc_id", "text")
    rules = quality_rules.ordered(quality_rules.estimates(quality_rules.RULES, texts))
    documents = quality_rules.measured(texts)
    measures = F.col("measures")
    failed = quality_rules.base_failed(measures)
    rejected_by = quality_rules.first_failed(rules, F.col("text"), measures)
    return documents.select(
        "doc_id",
        *(
            measures[name].alias(name)
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ),
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(rejected_by.isNull()).alias("kept"),
    )


def op8_quality_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Importance weight of every document and whether the resampling keeps it."""
    return resampled(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back from the token file."""
    path = working_path(spark, "llm-token-file")
    write_token_file(
        _table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    return read_token_file(spark, path, with_ids=False)


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Words, base phrases, labels and score of every document."""
    found = _table(spark, folder, "documents").select("doc_id", licenses.scan(F.col("text")).alias("s"))
    starts = F.transform("s.places", lambda p: p["at"])
    return found.select(
        "doc_id",
        F.col("s.n_words").alias("n_words"),
        F.size("s.places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("s.base_labels", ",").alias("base_labels"),
        F.array_join("s.labels", ",").alias("labels"),
        F.col("s.score").alias("score"),
    )


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, those dropped, and the digest of the text that stays."""
    kept = without_shared_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every vector, the error of its label, and the digest of all codebooks."""
    coded, books = vector_codes(_table(spark, folder, "embeddings"))
    digest = F.lit(books.digest() if books else "").alias("codebooks_sha256")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", digest)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_near_dedup": op2_near_dedup,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_selection": op8_quality_selection,
    "op9_token_files": op9_token_files,
    "op10_license_scan": op10_license_scan,
    "op11_line_dedup": op11_line_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_codes": op13_vector_codes,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORD = r"[^\x20\x09-\x0D]+"

# The plain patterns of op3, and the checks of their matches m, which start at p of the text t.
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda d, i:
    CASE WHEN i % 2 = 1 THEN CAST(d AS INT) WHEN d >= '5' THEN 2 * CAST(d AS INT) - 9
         ELSE 2 * CAST(d AS INT) END)) % 10 = 0"""
_MOD_97 = """list_reduce(list_transform(string_split(bare[5:] || bare[:4], ''), lambda c: CAST(
    CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END AS BIGINT)),
    lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97, CAST(0 AS BIGINT)) = 1"""
# Between words are all signs but letters and digits of any alphabet.
_SSN_WORD = rf"(?:^|[^\pL\pN_])(?:{pii.WORDS['ssn']})(?:$|[^\pL\pN_])"
_PII_SQL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "len(list_filter(string_split(m, '.'), lambda x: CAST(x AS HUGEINT) > 255)) = 0",
    ),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"len({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"len({_DIGITS}) BETWEEN 10 AND 15"),
    "iban": (
        r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
        f"len(bare) BETWEEN 15 AND 34 AND {_MOD_97}",
    ),
    "ssn": (
        r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
        f"""(regexp_matches(lower(substr(t, greatest(p - 40, 0) + 1, least(p, 40))), '{_SSN_WORD}')
            OR regexp_matches(lower(substr(t, p + length(m) + 1, 40)), '{_SSN_WORD}'))""",
    ),
    "card_number": (r"\b(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})\b", _LUHN),
    "phone_number": (
        r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}\b",
        f"len({_DIGITS}) BETWEEN 10 AND 15",
    ),
}
_PII_ROWS = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {k} AS k, p, p + length(m) AS q FROM (
        SELECT *, replace(m, ' ', '') AS bare FROM (
            SELECT doc_id, t, ms[i] AS m, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS p
            FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
                SELECT doc_id, t, regexp_extract_all(t, '{regex}') AS ms,
                       string_split_regex(t, '{regex}') AS ps
                FROM d WHERE regexp_matches(t, '{regex}')))))
        WHERE {check}"""
    for k, (kind, (regex, check)) in enumerate(_PII_SQL.items())
)

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# op13: assignment to the nearest entry (ties to the lower index), then floors of the means.
_ROUNDS = 4


def _assigned_sql(k: int) -> str:
    return f"""a{k} AS MATERIALIZED (
            SELECT r, p, min_by(e, d * 256 + e) AS e, min(d) AS d FROM (
                SELECT m.r, m.p, b.e, CAST(list_sum(list_transform(range(1, len(m.v) + 1),
                    lambda i: (m.v[i] - b.v[i]) * (m.v[i] - b.v[i]))) AS BIGINT) AS d
                FROM parts AS m JOIN b{k} AS b USING (p))
            GROUP BY r, p)"""


def _updated_sql(k: int) -> str:
    return f"""b{k + 1} AS MATERIALIZED (
            SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM b{k} AS b LEFT JOIN (
                SELECT p, e, list(x ORDER BY i) AS v FROM (
                    SELECT p, e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (
                        SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i
                        FROM parts JOIN a{k} USING (r, p))
                    GROUP BY p, e, i)
                GROUP BY p, e) AS n USING (p, e))"""


_LLOYD = ", ".join(f"{_assigned_sql(k)}, {_updated_sql(k)}" for k in range(_ROUNDS))

_SIGNATURES = ", ".join(
    f"('{r.label}', '{r.keyword}', '{r.regex}', {r.priority}, {r.score})" for r in signatures()
)
_KEYWORDS = "|".join(sorted({r.keyword.replace(" ", r"\s+") for r in signatures()}))

ORACLES = {
    "op2_near_dedup": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS ws FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE
                WHEN len(ws) = 0 THEN []
                WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 1),
                    lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh
            FROM w
        ), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM e AS a JOIN e AS b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach(doc_id, node) AS (
            SELECT doc_id, doc_id FROM s
            UNION
            SELECT r.doc_id, l.b FROM reach AS r JOIN links AS l ON r.node = l.a
        ), grouped AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id,
               doc_id = component_id AS kept
        FROM s JOIN grouped USING (doc_id)
    """,
    "op3_pii": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), every_span AS ({_PII_ROWS}),
        f AS (
            SELECT * FROM every_span AS s WHERE NOT EXISTS (
                SELECT 1 FROM every_span AS b WHERE b.doc_id = s.doc_id AND s.kind = b.kind || '_number'
                    AND b.p < s.q AND s.p < b.q)
        ),
        g AS (
            SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{x}') AS n_{x}" for x in pii.BASE_KINDS)},
                   string_agg(kind || ':' || p || ':' || q, ',' ORDER BY p, k) FILTER (k < 4) AS base,
                   string_agg(kind || ':' || p || ':' || q, ',' ORDER BY p, k) AS spans
            FROM f GROUP BY doc_id
        )
        SELECT doc_id, {", ".join(f"CAST(coalesce(n_{x}, 0) AS BIGINT) AS n_{x}" for x in pii.BASE_KINDS)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(g.spans, '') AS spans
        FROM d LEFT JOIN g USING (doc_id)
    """,
    "op4_decontamination": r"""
        WITH texts AS (
            SELECT * FROM (
                SELECT 0 AS kind, item_id AS id, regexp_extract_all(lower(text), '[\pL\pN]+') AS w
                FROM benchmark
                UNION ALL
                SELECT 1, doc_id, regexp_extract_all(lower(text), '[\pL\pN]+') FROM documents)
            WHERE len(w) > 0
        ), short AS (
            SELECT coalesce(list(DISTINCT len(w)), []) AS lengths FROM texts WHERE kind = 0 AND len(w) < 5
        ), sets AS (
            SELECT kind, id, list_distinct(list_concat(
                CASE WHEN len(w) < 6 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END,
                CASE WHEN kind = 0 THEN [] ELSE flatten(list_transform(lengths, lambda n: CASE WHEN len(w) < n THEN []
                    ELSE list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' ')) END))
                END)) AS own
            FROM texts, short
        ), e AS (SELECT kind, id, len(own) AS n, unnest(own) AS s FROM sets)
        SELECT d.id AS doc_id, i.id AS item_id, CAST(i.n AS INT) AS n_item_shingles,
               CAST(count(*) AS INT) AS n_shared
        FROM e AS i JOIN e AS d ON i.s = d.s AND i.kind = 0 AND d.kind = 1
        GROUP BY d.id, i.id, i.n HAVING 100 * count(*) >= 80 * i.n
    """,
    "op7_quality_rules": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), windows AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
        ), repeated AS (
            SELECT r, count(DISTINCT i + k) AS n_repeat_words
            FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r
        ), m AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   len(lines) AS n_lines,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                   length(t) - length(replace(t, '!', '')) AS n_exclamations,
                   length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')) AS n_capitals,
                   length(t) - length(regexp_replace(t, '\p{L}+', '', 'g')) AS n_letters
            FROM d LEFT JOIN repeated USING (r)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
                    OR 10 * n_symbols > n_words OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
                    OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
                    OR 10 * n_exclamations > 3 * n_words OR 10 * n_capitals > 4 * word_chars
                    OR 2 * n_letters < word_chars) AS kept
        FROM m
    """,
    "op10_license_scan": rf"""
        WITH rules(label, keyword, regex, priority, score) AS (VALUES {_SIGNATURES}),
        phrases(label, p) AS (VALUES ('cc-by', ['cc', 'by']),
            ('gpl', ['general', 'public', 'license']), ('reserved', ['all', 'rights', 'reserved'])),
        d AS (
            SELECT row_number() OVER () AS r, doc_id, l,
                   regexp_extract_all(l, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT doc_id, {_LOWERED} AS l FROM documents)
        ), base AS (
            SELECT r, label, unnest(list_filter(range(0, len(w)),
                lambda i: w[i + 1:i + len(p)] = p)) AS pos
            FROM d, phrases WHERE list_contains(w, p[-1])
        ), gated AS (
            SELECT r, l, regexp_replace(l, '\s+', ' ', 'g') AS flat FROM d WHERE regexp_matches(l, '{_KEYWORDS}')
        ), split AS (
            SELECT r, label, priority, score, regexp_extract_all(l, regex) AS ms,
                   string_split_regex(l, regex) AS ps
            FROM gated JOIN rules ON contains(flat, keyword)
        ), found AS (
            SELECT r, label, priority, score, pos, pos + length(ms[i]) AS until FROM (
                SELECT *, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS pos
                FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM split))
        ), kept AS (
            SELECT * FROM found AS x WHERE NOT EXISTS (
                SELECT 1 FROM found AS y
                WHERE y.r = x.r AND y.pos <= x.pos AND y.until >= x.until AND (y.priority > x.priority
                    OR (y.priority = x.priority AND y.until - y.pos > x.until - x.pos)))
        ), b AS (
            SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
                   list_sort(list_distinct(list(label))) AS ls FROM base GROUP BY r
        ), k AS (SELECT r, max(score) AS best, list(label) AS ls FROM kept GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
               CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
               coalesce(array_to_string(b.ls, ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(
                   list_concat(coalesce(b.ls, []), coalesce(k.ls, [])))), ','), '') AS labels,
               CAST(greatest(coalesce(best, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
        FROM d LEFT JOIN b USING (r) LEFT JOIN k USING (r)
    """,
    "op11_line_dedup": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
        ), l AS (
            SELECT r, doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                '{_UPPER}', '{_UPPER.lower()}') AS key
            FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)
        ), f AS (
            SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT r) >= 5
        ), m AS (
            SELECT r, doc_id, i, line, f.key IS NOT NULL AND l.doc_id IS DISTINCT FROM f.keeper AS gone
            FROM l LEFT JOIN f USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY r, doc_id
    """,
    "op12_lexical_search": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS ws FROM documents
        ), c AS (
            SELECT count(*) FILTER (len(ws) > 0) AS n_all, CAST(sum(len(ws)) AS BIGINT) AS l_all FROM d
        ), q AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS term FROM benchmark)
            GROUP BY item_id, term
        ), t AS (
            SELECT r, doc_id, n, term, count(*) AS tf
            FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS term FROM d)
            WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM t, c GROUP BY term, n_all
        ), s AS (
            SELECT item_id, r, doc_id, CAST(sum(times * w
                * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_all) // l_all)))) AS BIGINT) AS score
            FROM q JOIN t USING (term) JOIN w USING (term), c GROUP BY item_id, r, doc_id
        )
        SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
        WHERE rank <= 10
    """,
    "op13_vector_codes": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding,
                lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (
            SELECT r, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS v
            FROM (SELECT r, v, unnest([0, 1, 2, 3]) AS p FROM kept)
        ), b0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= 256),
        {_LLOYD}, {_assigned_sql(_ROUNDS)},
        coded AS (
            SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM a{_ROUNDS} GROUP BY r
        )
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b{_ROUNDS}) AS codebooks_sha256
        FROM kept JOIN coded USING (r)
    """,
}
