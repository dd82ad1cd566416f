"""The registered queries once more, as SQL for another engine.

Written from the definitions of the operators, not from their Spark plans.
Only the fixed values (limits, patterns of the review view, character
references) are shared.
"""

from __future__ import annotations

from reviewsieve.fixed_values import (
    AMPERSAND_FORMS,
    ENTITIES,
    METADATA_LIKE_FIELDS,
    MIN_REVIEW_COUNT,
    PROFILE_SIZE,
    RATING_ALIASES,
    REASONS,
    REVIEW_LIKE_FIELDS,
    TEXT_ALIASES,
)
from reviewsieve.plans.review_view import REVIEW_VIEW

SPACES = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NUMBER = r"^[ \t\r\n]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"
MARKED = "regexp_matches({}, '<[^>]+>')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _names(names) -> str:
    return "(" + ", ".join(_quote(n) for n in names) + ")"


def tidy(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACES}+', ' ', 'g'))"


def decode(x: str) -> str:
    for reference, character in ENTITIES:
        x = f"replace({x}, {_quote(reference)}, {_quote(character)})"
    for reference in AMPERSAND_FORMS:
        x = f"replace({x}, {_quote(reference)}, '&')"
    return x


def strip(x: str) -> str:
    for pattern in (
        r"(?s)<!--.*?-->",
        r"(?is)<script\b.*?(?:</script\s*>|\z)",
        r"(?is)<style\b.*?(?:</style\s*>|\z)",
        r"<[A-Za-z/!?][^>]*>",
    ):
        x = f"regexp_replace({x}, '{pattern}', ' ', 'g')"
    return decode(x)


def normalized(x: str) -> str:
    marked = MARKED.format(x)
    return f"coalesce({tidy(f'CASE WHEN {marked} THEN {strip(x)} ELSE {x} END')}, '')"


def rating(x: str) -> str:
    number = f"TRY_CAST(CASE WHEN regexp_matches({x}, '{NUMBER}') THEN trim({x}) END AS DOUBLE)"
    return f"CASE WHEN {number} IN (1, 2, 3, 4, 5) THEN CAST({number} AS INTEGER) END"


def outer_strip(x: str) -> str:
    return (
        f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), "
        f"'^{SPACES}+|{SPACES}+\\z', '', 'g')"
    )


def hashed(asin: str, user_id: str, stars: str, title: str, text: str) -> str:
    return (
        f"sha256('asin=' || {outer_strip(asin)} || '|user_id=' || {outer_strip(user_id)}"
        f" || '|rating=' || {outer_strip(stars)}"
        f" || '|title=' || coalesce({tidy(title)}, '') || '|text=' || coalesce({tidy(text)}, ''))"
    )


def _grams(source: str, key: str, text: str) -> str:
    """(key, gram) for each trigram of each padded word."""
    return f"""
        SELECT {key}, unnest([substr(word, i, 3) FOR i IN range(1, length(word) - 1)]) AS gram
        FROM (
            SELECT {key}, ' ' || w || ' ' AS word
            FROM (
                SELECT {key}, unnest(string_split(
                    trim(regexp_replace(lower({text}), '[^\\p{{L}}]+', ' ', 'g')), ' ')) AS w
                FROM {source}
            ) WHERE w <> ''
        )"""


REVIEWS = "reviews AS (SELECT {} FROM documents)".format(
    ", ".join(f"{sql} AS {name}" for name, sql in REVIEW_VIEW.items())
)

PROFILES = f"""
    profiles AS (
        SELECT lang, gram, CAST(place AS INTEGER) AS rank FROM (
            SELECT lang, gram,
                row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS place
            FROM ({_grams('documents', 'lang', 'text')}) GROUP BY lang, gram
        ) WHERE place <= {PROFILE_SIZE}
    )"""


def detected(source: str, text: str) -> str:
    """CTE `languages` (ingest_seq, language)."""
    return f"""
    languages AS (
        SELECT ingest_seq, lang AS language FROM (
            SELECT ingest_seq, lang, row_number() OVER (
                PARTITION BY ingest_seq
                ORDER BY sum({PROFILE_SIZE + 1} - rank) DESC, lang) AS place
            FROM ({_grams(source, 'ingest_seq', text)}) JOIN profiles USING (gram)
            GROUP BY ingest_seq, lang
        ) WHERE place = 1
    )"""


CHECKED = f"""
    checked AS (
        SELECT *, {normalized('text')} AS norm_text, {rating('rating')} AS norm_rating FROM reviews
    ),
    passed AS (
        SELECT * FROM checked WHERE length(norm_text) >= 3 AND norm_rating IS NOT NULL
    )"""

JUDGED = f"""
    judged AS (
        SELECT c.*, l.language,
            CASE WHEN length(norm_text) < 3 THEN 'empty_or_too_short'
                 WHEN norm_rating IS NULL THEN 'invalid_rating'
                 WHEN l.language IS NULL THEN 'undetectable_language'
                 WHEN l.language <> 'en' THEN 'non_english' END AS reason
        FROM checked c LEFT JOIN languages l USING (ingest_seq)
    ),
    clean AS (
        SELECT * REPLACE (norm_rating AS rating),
            norm_text AS text_normalized,
            {normalized('title')} AS title_normalized,
            {hashed('asin', 'user_id', 'norm_rating', normalized('title'), 'norm_text')}
                AS review_hash
        FROM judged WHERE reason IS NULL
    )"""

KEYED = f"""
    keyed AS (
        SELECT ingest_seq, asin, user_id, {rating('rating')} AS rating,
            coalesce({tidy('title')}, '') AS title_normalized,
            coalesce({tidy('text')}, '') AS text_normalized
        FROM reviews
    ),
    numbered AS (
        SELECT *, row_number() OVER (same ORDER BY ingest_seq) AS copy,
            count(*) OVER same AS copies
        FROM keyed
        WINDOW same AS (
            PARTITION BY asin, user_id, rating, title_normalized, text_normalized)
    )"""

COLUMNS = ", ".join(REVIEW_VIEW)
COLUMN_NAMES = "names AS (SELECT DISTINCT unnest(json_keys(to_json(reviews))) AS name FROM reviews)"
VALIDATED = [REVIEWS, CHECKED, PROFILES, detected("passed", "norm_text"), JUDGED]
SORTED_FIELDS = sorted(REVIEW_VIEW)


def _with(ctes, select: str) -> str:
    return "WITH " + ",".join(ctes) + " " + select


def _key_sets(table: str, fields: list[str], floats: tuple[str, ...] = ()) -> str:
    def mark(field):
        absent = f"{field} IS NULL" + (f" OR isnan({field})" if field in floats else "")
        return f"CASE WHEN {absent} THEN NULL ELSE '{field}' END"

    keys = "concat_ws(',', " + ", ".join(mark(f) for f in fields) + ")"
    return f"key_sets AS (SELECT {keys} AS key_set, count(*) AS records FROM {table} GROUP BY 1)"


REVIEW_KEY_SETS = [REVIEWS, _key_sets("reviews", SORTED_FIELDS)]
KNOWN_FIELDS = """
    seen AS (
        SELECT field, CAST(sum(records) AS BIGINT) AS rows_present
        FROM (SELECT unnest(string_split(key_set, ',')) AS field, records FROM key_sets)
        GROUP BY field
    ),
    known AS (
        SELECT field, 'review' AS kind, rows_present FROM seen WHERE field IN {review}
        UNION ALL
        SELECT field, 'metadata', rows_present FROM seen WHERE field IN {metadata}
    )""".format(review=_names(REVIEW_LIKE_FIELDS), metadata=_names(METADATA_LIKE_FIELDS))

REASON_COUNTS = ", ".join(
    f"count(*) FILTER (reason = '{reason}') AS {reason}" for reason in REASONS
)
# Batch 0 holds the verified purchases, batch 1 all reviews.
EARLIER = "earlier AS (SELECT DISTINCT review_hash FROM clean WHERE verified_purchase)"
LATER = """
    later AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY review_hash ORDER BY ingest_seq) AS copy
            FROM clean
        ) WHERE copy = 1 AND review_hash NOT IN (SELECT review_hash FROM earlier)
    )"""
BATCH_STATS = f"""
    first_batch AS (
        SELECT count(*) AS input_records, {REASON_COUNTS},
            count(*) FILTER (reason IS NULL) AS valid_before_deduplication,
            (SELECT count(*) FROM earlier) AS clean_records
        FROM judged WHERE verified_purchase
    ),
    second_batch AS (
        SELECT count(*) AS input_records, {REASON_COUNTS},
            count(*) FILTER (reason IS NULL) AS valid_before_deduplication,
            (SELECT count(*) FROM later) AS clean_records
        FROM judged
    )"""
STAT_COLUMNS = (
    "input_records, "
    + ", ".join(REASONS)
    + ", valid_before_deduplication,"
    + " valid_before_deduplication - clean_records AS duplicate_records, clean_records"
)
WHOLE_STATS = f"""
    stats AS (
        SELECT count(*) AS input_records, {REASON_COUNTS},
            count(*) FILTER (reason IS NULL) AS valid_before_deduplication,
            (SELECT count(DISTINCT review_hash) FROM clean) AS clean_records
        FROM judged
    )"""


OPEN_SETS = """
    open_sets AS (
        SELECT fields, array_to_string(fields, ',') AS key_set, count(*) AS records FROM (
            SELECT list_sort(list_filter(['doc_id', CASE WHEN lang IS NOT NULL THEN 'lang' END, CASE WHEN source IS NOT NULL THEN 'source' END,
                CASE WHEN quality IS NOT NULL THEN 'quality' END, CASE WHEN toxic IS NOT NULL THEN 'toxic' END, source], lambda f: f IS NOT NULL)) AS fields
            FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY ALL
    )"""


def expected() -> dict[str, str]:
    plain = f"SELECT {COLUMNS} FROM reviews"
    clean_rows = "ingest_seq, rating, text_normalized, title_normalized, review_hash"
    return {
        # Sources and sinks.
        "s1_read_jsonl": _with([REVIEWS], plain),
        "s3_read_csv": _with(
            [REVIEWS], plain
        ),
        "s4_read_reviews": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "s5_read_uploaded_data": _with([REVIEWS], plain),
        "s2_read_json_document": _with([REVIEWS], plain),
        "s4_read_json_lines": _with([REVIEWS], plain),
        "s6_read_reviews_stream": _with([REVIEWS], plain),
        "s7_first_rows": _with([REVIEWS], plain + " ORDER BY ingest_seq LIMIT 150"),
        "c1_find_column": _with(
            [REVIEWS],
            """SELECT 'conversations' AS table_name, 'text' AS text_column, NULL AS rating_column,
                count(text) AS text_values, 0 AS rating_values FROM conversations
            UNION ALL SELECT 'pages', NULL, NULL, 0, 0 FROM (SELECT count(*) FROM pages)
            UNION ALL SELECT 'reviews', 'text', 'rating', count(text), count(rating) FROM reviews""",
        ),
        "c7_validate_review_schema": _with(
            [REVIEWS, COLUMN_NAMES],
            f"""SELECT (SELECT count(*) FROM reviews) AS records,
                string_agg(name, ',' ORDER BY name) FILTER (name IN {_names(REVIEW_LIKE_FIELDS)}) AS review_like,
                string_agg(name, ',' ORDER BY name) FILTER (name IN {_names(METADATA_LIKE_FIELDS)}) AS metadata_like,
                max(name) FILTER (name = 'text') AS text_column, max(name) FILTER (name = 'rating') AS rating_column,
                bool_or(name = 'text') AND bool_or(name = 'rating') AS is_valid FROM names""",
        ),
        "c8_validate_required_columns": "SELECT event_type, count(*) AS events FROM events GROUP BY event_type",
        "s8_save_dataframe": "SELECT conv_id, turn, role, text FROM conversations",
        "s9_append_clean": _with(
            VALIDATED,
            f"""SELECT {clean_rows}, strftime(make_timestamp(timestamp * 1000),
                '%Y-%m-%dT%H:%M:%S.%g') AS timestamp FROM clean""",
        ),
        # Schema.
        "c2_key_sets": _with(REVIEW_KEY_SETS, "SELECT key_set, records FROM key_sets"),
        "c2_event_key_sets": _with(
            [
                _key_sets(
                    "events",
                    ["event_id", "event_type", "props", "ts", "user_id", "value"],
                    floats=("value",),
                )
            ],
            "SELECT key_set, records FROM key_sets",
        ),
        "c2_json_key_sets": _with([OPEN_SETS], "SELECT key_set, records FROM open_sets"),
        "c3_json_schema_summary": _with(
            [OPEN_SETS, "names AS (SELECT DISTINCT unnest(fields) AS f FROM open_sets)"],
            """SELECT CAST(sum(records) AS BIGINT) AS total_rows, (SELECT count(*) FROM names) AS columns_seen_count,
                (SELECT string_agg(f, ',' ORDER BY f) FROM names) AS columns_seen, count(*) AS distinct_key_sets FROM open_sets""",
        ),
        "c5_json_absent_fields": _with(
            [OPEN_SETS],
            """SELECT DISTINCT unnest(fields) AS field FROM open_sets
            EXCEPT SELECT unnest(fields) FROM (SELECT fields FROM open_sets ORDER BY records DESC, fields LIMIT 1)""",
        ),
        "c3_schema_summary": _with(
            REVIEW_KEY_SETS,
            """SELECT CAST(sum(records) AS BIGINT) AS total_rows,
                (SELECT count(DISTINCT f) FROM
                    (SELECT unnest(string_split(key_set, ',')) AS f FROM key_sets))
                    AS columns_seen_count,
                (SELECT string_agg(f, ',' ORDER BY f) FROM
                    (SELECT DISTINCT unnest(string_split(key_set, ',')) AS f FROM key_sets))
                    AS columns_seen,
                count(*) AS distinct_key_sets FROM key_sets""",
        ),
        "c4_top_key_sets": _with(
            REVIEW_KEY_SETS,
            """SELECT key_set, records FROM key_sets
            ORDER BY records DESC, string_split(key_set, ',') LIMIT 5""",
        ),
        "c5_sometimes_absent_fields": _with(
            REVIEW_KEY_SETS,
            """SELECT unnest(string_split(key_set, ',')) AS field FROM key_sets
            EXCEPT
            SELECT unnest(string_split(key_set, ',')) FROM (
                SELECT key_set FROM key_sets
                ORDER BY records DESC, string_split(key_set, ',') LIMIT 1)""",
        ),
        "c5_absent_label_fields": _with(
            [
                "labelled AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))",
                _key_sets("labelled", ["doc_id", "lang", "quality", "source", "toxic"]),
            ],
            """SELECT unnest(string_split(key_set, ',')) AS field FROM key_sets
            EXCEPT
            SELECT unnest(string_split(key_set, ',')) FROM (
                SELECT key_set FROM key_sets
                ORDER BY records DESC, string_split(key_set, ',') LIMIT 1)""",
        ),
        "c6_known_fields": _with([*REVIEW_KEY_SETS, KNOWN_FIELDS], "SELECT * FROM known"),
        "c6_classify_dataset": _with(
            [*REVIEW_KEY_SETS, KNOWN_FIELDS],
            f"""SELECT
                coalesce(string_agg(field, ',' ORDER BY field)
                    FILTER (kind = 'review'), '') AS review_like_fields_found,
                coalesce(string_agg(field, ',' ORDER BY field)
                    FILTER (kind = 'metadata'), '') AS metadata_like_fields_found,
                bool_or(kind = 'metadata') AND NOT bool_or(kind = 'review') AS is_metadata_file,
                bool_or(kind = 'review') AND bool_or(field IN {_names(TEXT_ALIASES)})
                    AND bool_or(field IN {_names(RATING_ALIASES)}) AS is_review_data
            FROM known""",
        ),
        # Profiles.
        "p1_rating_distribution": _with(
            [REVIEWS],
            """SELECT rating, count(*) AS reviews FROM reviews
            WHERE rating IS NOT NULL GROUP BY rating ORDER BY rating""",
        ),
        "p1_event_distribution": "SELECT event_type, count(*) AS reviews FROM events GROUP BY 1",
        "p2_text_missing_stats": _with(
            [REVIEWS],
            f"""SELECT total_rows, null_count, blank_count,
                null_count / total_rows AS null_share, blank_count / total_rows AS blank_share
            FROM (SELECT count(*) AS total_rows,
                count(*) FILTER (text IS NULL) AS null_count,
                count(*) FILTER ({tidy('text')} = '') AS blank_count FROM reviews)""",
        ),
        "p3_column_null_counts": _with(
            [REVIEWS],
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM reviews"
                for c in REVIEW_VIEW
            ),
        ),
        "p4_seeded_sample": _with(
            [REVIEWS],
            """SELECT ingest_seq, asin, text FROM reviews
            ORDER BY sha256('42:' || CAST(ingest_seq AS VARCHAR)), ingest_seq LIMIT 100""",
        ),
        "p5_language_estimate": _with(
            [
                REVIEWS,
                PROFILES,
                """sampled AS (SELECT ingest_seq, text FROM reviews WHERE length(text) > 0
                ORDER BY sha256('42:' || CAST(ingest_seq AS VARCHAR)), ingest_seq LIMIT 150)""",
                detected("sampled", "text"),
            ],
            """SELECT sample_size, non_english, undetectable,
                non_english / sample_size AS non_english_share,
                undetectable / sample_size AS undetectable_share
            FROM (SELECT count(*) AS sample_size,
                count(*) FILTER (language <> 'en') AS non_english,
                count(*) FILTER (language IS NULL) AS undetectable
                FROM sampled LEFT JOIN languages USING (ingest_seq))""",
        ),
        "p6_html_rate": _with(
            [REVIEWS],
            f"""SELECT total_rows, html_count, html_count / total_rows AS html_share
            FROM (SELECT count(*) AS total_rows,
                count(*) FILTER ({MARKED.format('text')}) AS html_count FROM reviews)""",
        ),
        "p7_html_examples": _with(
            [REVIEWS],
            f"""SELECT ingest_seq, text FROM reviews WHERE {MARKED.format('text')}
            ORDER BY ingest_seq LIMIT 10""",
        ),
        "p8_exploration_summary": _with(
            [*REVIEW_KEY_SETS, COLUMN_NAMES],
            f"""SELECT total_rows, (SELECT count(*) FROM key_sets) AS distinct_key_sets,
                (SELECT max(name) FILTER (name = 'rating') FROM names) AS rating_column,
                (SELECT max(name) FILTER (name = 'text') FROM names) AS text_column, null_or_blank_text,
                null_or_blank_text / total_rows AS null_or_blank_share,
                (SELECT bool_or(name = 'text') AND bool_or(name = 'rating') FROM names) AS is_review_data
            FROM (SELECT count(*) AS total_rows,
                count(*) FILTER (text IS NULL OR {tidy('text')} = '') AS null_or_blank_text
                FROM reviews)""",
        ),
        # Text.
        "t1_normalize_whitespace": f"""SELECT doc_id, {tidy('text')} AS tidy_text
            FROM documents""",
        "t2_strip_html": f"SELECT page_id, {strip('html')} AS visible_text FROM pages",
        "t3_clean_html": f"SELECT page_id, {strip(decode('html'))} AS visible_text FROM pages",
        "t4_normalize_review_text": _with(
            [REVIEWS], f"SELECT ingest_seq, {normalized('text')} AS normalized_text FROM reviews"
        ),
        "t4_normalize_page_text": f"""SELECT page_id, {normalized('html')} AS normalized_text
            FROM pages""",
        "t5_normalize_for_duplicate": f"""SELECT conv_id, turn,
            coalesce({tidy('text')}, '') AS comparable_text FROM conversations""",
        "t6_validate_rating": _with(
            [REVIEWS],
            f"""SELECT ingest_seq, rating AS raw_rating, {rating('rating')} AS rating
            FROM reviews""",
        ),
        "t7_review_hash": _with(
            [REVIEWS],
            f"""SELECT ingest_seq,
                {hashed('asin', 'user_id', 'rating', 'title', 'text')} AS review_hash
            FROM reviews""",
        ),
        # Languages.
        "l0_language_profiles": _with([PROFILES], "SELECT lang, gram, rank FROM profiles"),
        "l1_detect_language": _with(
            [
                "texts AS (SELECT doc_id AS ingest_seq, text FROM documents)",
                PROFILES,
                detected("texts", "text"),
            ],
            """SELECT ingest_seq, CASE WHEN text = '' THEN 'en' ELSE language END AS language
            FROM texts LEFT JOIN languages USING (ingest_seq)""",
        ),
        "l1_detect_turns": _with(
            [
                """texts AS (SELECT {'conv_id': conv_id, 'turn': turn} AS ingest_seq, conv_id, turn, text
                FROM conversations)""",
                PROFILES,
                detected("texts", "text"),
            ],
            """SELECT conv_id, turn, CASE WHEN coalesce(text, '') = '' THEN 'en' ELSE language END AS language
            FROM texts LEFT JOIN languages USING (ingest_seq)""",
        ),
        "l2_language_filter": _with(
            [REVIEWS, PROFILES, detected("reviews", "text")],
            """SELECT ingest_seq, language, coalesce(language = 'en', false) AS accepted
            FROM (SELECT ingest_seq,
                CASE WHEN coalesce(text, '') = '' THEN 'en' ELSE language END AS language
                FROM reviews LEFT JOIN languages USING (ingest_seq))""",
        ),
        # Validation.
        "v1_validate_reviews": _with(
            VALIDATED,
            """SELECT ingest_seq, reason IS NULL AS valid, reason, norm_text AS normalized_text,
                CASE WHEN length(norm_text) >= 3 THEN norm_rating END AS normalized_rating,
                language AS detected_language FROM judged""",
        ),
        "v1_rejection_counts": _with(
            VALIDATED, "SELECT reason, count(*) AS reviews FROM judged GROUP BY reason"
        ),
        "v1_split_missing": _with(
            VALIDATED,
            """SELECT ingest_seq, CASE WHEN text IS NULL THEN 'missing_text'
                WHEN norm_text = '' THEN 'empty_text' ELSE reason END AS reason FROM judged""",
        ),
        "v2_preprocess_reviews": _with(
            VALIDATED,
            f"SELECT {COLUMNS}, text_normalized, title_normalized, review_hash FROM clean",
        ),
        "v3_rejected_reviews": _with(
            VALIDATED, f"SELECT {COLUMNS}, reason FROM judged WHERE reason IS NOT NULL"
        ),
        # Duplicates.
        "u1_drop_duplicate_reviews": _with(
            [REVIEWS, KEYED],
            """SELECT ingest_seq, asin, user_id, rating, title_normalized, text_normalized
            FROM numbered WHERE copy = 1""",
        ),
        "u2_duplicate_mask": _with(
            [REVIEWS, KEYED], "SELECT ingest_seq, copy > 1 AS is_duplicate FROM numbered"
        ),
        "u2_duplicate_turns": """SELECT conv_id, turn,
            row_number() OVER (PARTITION BY text ORDER BY conv_id, turn) > 1 AS is_duplicate
            FROM conversations""",
        "u3_duplicate_groups": _with(
            [REVIEWS, KEYED],
            """SELECT ingest_seq, asin, user_id, rating, title_normalized, text_normalized, copies
            FROM numbered WHERE copies > 1""",
        ),
        "u4_duplicate_report": _with(
            [REVIEWS, KEYED],
            """SELECT count(*) AS before_count, count(*) FILTER (copy > 1) AS removed_count,
                count(*) FILTER (copy = 1) AS after_count FROM numbered""",
        ),
        "u5_hash_uniqueness": _with(
            VALIDATED,
            """SELECT count(*) AS total_rows, count(DISTINCT review_hash) AS unique_hashes,
                count(*) - count(DISTINCT review_hash) AS repeated_rows FROM clean""",
        ),
        "u6_known_hashes": _with(
            [*VALIDATED, EARLIER],
            """SELECT ingest_seq, review_hash FROM clean
            WHERE review_hash IN (SELECT review_hash FROM earlier)""",
        ),
        "u7_new_hashes": _with(
            [*VALIDATED, EARLIER, LATER], "SELECT ingest_seq, review_hash FROM later"
        ),
        "u8_store_listing": _with(
            [*VALIDATED, EARLIER, LATER],
            """SELECT review_hash, 'load' AS run_id, CAST(0 AS BIGINT) AS batch_id FROM earlier
            UNION ALL SELECT review_hash, 'load', 1 FROM later""",
        ),
        "u9_increment_clean": _with(
            [*VALIDATED, EARLIER, LATER], f"SELECT {clean_rows} FROM later"
        ),
        "u9_increment_stats": _with(
            [*VALIDATED, EARLIER, LATER, BATCH_STATS], f"SELECT {STAT_COLUMNS} FROM second_batch"
        ),
        # Quality.
        "q1_record_stats": _with([*VALIDATED, WHOLE_STATS], f"SELECT {STAT_COLUMNS} FROM stats"),
        "q2_accumulate_stats": _with(
            [*VALIDATED, EARLIER, LATER, BATCH_STATS],
            "SELECT "
            + ", ".join(
                f"CAST(sum({c}) AS BIGINT) AS {c}"
                for c in (
                    "input_records",
                    *REASONS,
                    "valid_before_deduplication",
                    "duplicate_records",
                    "clean_records",
                )
            )
            + f""", count(*) AS chunks_processed FROM (
                SELECT {STAT_COLUMNS} FROM first_batch
                UNION ALL SELECT {STAT_COLUMNS} FROM second_batch)""",
        ),
        "q3_data_sufficiency": _with(
            VALIDATED,
            f"""SELECT count(*) AS valid_review_count,
                CAST({MIN_REVIEW_COUNT} AS BIGINT) AS minimum_required,
                count(*) >= {MIN_REVIEW_COUNT} AS is_sufficient,
                greatest(0, {MIN_REVIEW_COUNT} - count(*)) AS deficit FROM clean""",
        ),
        "q3_sufficient": _with(
            VALIDATED,
            """SELECT count(*) AS valid_review_count, CAST(20 AS BIGINT) AS minimum_required,
                count(*) >= 20 AS is_sufficient, greatest(0, 20 - count(*)) AS deficit FROM clean""",
        ),
        "q4_reconcile": _with(
            [*VALIDATED, WHOLE_STATS, "firsts AS (SELECT min(ingest_seq) AS ingest_seq FROM clean GROUP BY review_hash)"],
            f"""SELECT clean_records = (SELECT count(*) FROM firsts) AS clean_equals_output,
                (SELECT count(DISTINCT review_hash) FROM clean) = clean_records AS stored_equals_clean,
                clean_records <= valid_before_deduplication
                    AND valid_before_deduplication <= input_records AS counts_ordered,
                clean_records > {MIN_REVIEW_COUNT} AS enough_clean,
                input_records = (SELECT count(*) FROM documents) AS input_as_expected,
                input_records = {' + '.join(REASONS)} + valid_before_deduplication
                    AS input_accounted_for,
                valid_before_deduplication = clean_records
                    + (SELECT count(*) FROM clean ANTI JOIN firsts USING (ingest_seq)) AS valid_accounted_for,
                (SELECT count(DISTINCT review_hash) FROM clean) AS stored_hashes, clean_records FROM stats""",
        ),
        # Streams.
        "x1_stream_clean": _with(
            VALIDATED,
            """SELECT DISTINCT review_hash, asin, user_id, rating, title_normalized,
                text_normalized FROM clean""",
        ),
        "x1_keyed_clean": _with(
            VALIDATED,
            """SELECT ingest_seq, review_hash, rating, title_normalized, text_normalized, CAST(ingest_seq % 3 AS BIGINT) AS batch_id
            FROM (SELECT *, row_number() OVER (PARTITION BY review_hash ORDER BY ingest_seq % 3, ingest_seq) AS copy FROM clean) WHERE copy = 1""",
        ),
        "x2_listener_progress": _with(
            [
                *VALIDATED,
                """first_seen AS (SELECT review_hash, min(ingest_seq % 3) AS batch_id FROM clean GROUP BY review_hash)""",
                """kept AS (SELECT batch_id, count(*) AS clean_records FROM first_seen GROUP BY 1)""",
                f"""batches AS (SELECT CAST(ingest_seq % 3 AS BIGINT) AS batch_id, count(*) AS input_records, {REASON_COUNTS},
                    count(*) FILTER (reason IS NULL) AS valid_before_deduplication FROM judged GROUP BY 1)""",
            ],
            """SELECT 'keyed' AS run_id, batches.*, CAST(sum(coalesce(clean_records, 0)) OVER (ORDER BY batch_id) AS BIGINT) AS state_rows
            FROM batches LEFT JOIN kept USING (batch_id)""",
        ),
        "x2_stream_progress": _with(
            [
                *VALIDATED,
                """first_seen AS (SELECT review_hash, min(ingest_seq % 3) AS batch_id FROM clean GROUP BY review_hash)""",
                """batches AS (SELECT ingest_seq % 3 AS batch_id, count(*) AS input_records FROM reviews GROUP BY 1)""",
                """kept AS (SELECT batch_id, count(*) AS clean_records FROM first_seen GROUP BY 1)""",
            ],
            """SELECT 'stream' AS run_id, batch_id, input_records,
                CAST(sum(input_records) OVER (ORDER BY batch_id) AS BIGINT) AS input_so_far,
                CAST(sum(coalesce(clean_records, 0)) OVER (ORDER BY batch_id) AS BIGINT) AS clean_so_far
            FROM batches LEFT JOIN kept USING (batch_id)""",
        ),
        "x2_stream_totals": _with(
            [*VALIDATED, WHOLE_STATS], f"SELECT {STAT_COLUMNS} FROM stats"
        ),
    }
