import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewsieve.functions import (
    clean_html,
    key_digest,
    normalize_for_duplicate,
    normalize_review_text,
    normalize_whitespace,
    review_hash,
    strip_html,
    validate_rating,
)

RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_every_unicode_space_collapses(column):
    spaces = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]
    got = column(normalize_whitespace, [f"a{s}{s}b" for s in spaces])
    assert got == ["a b"] * len(spaces)
    assert column(normalize_whitespace, ["a​b", " \t a \n ", None, "", "a b"]) == [
        "a​b",
        "a",
        None,
        "",
        "a b",
    ]


@RELAXED
@given(
    st.lists(
        st.text(alphabet=st.sampled_from("ab \t\n\r\x0b\x1c\x1f\x85  　​")),
        min_size=30,
        max_size=60,
    )
)
def test_whitespace_equals_python(column, texts):
    want = [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert column(normalize_whitespace, texts) == want


def test_markup_is_stripped_only_where_there_is_some(column):
    cases = {
        "This product works well.<br /><br />The installation was easy.": (
            "This product works well. The installation was easy."
        ),
        "a &amp; b": "a &amp; b",
        "<b>a</b> &amp; b": "a & b",
        "I <3 this > that": "I <3 this > that",
        "&lt;b&gt;x": "&lt;b&gt;x",
        "<i>&lt;b&gt;</i>x": "<b> x",
        "<p>&amp;lt;</p>": "&lt;",
        "x<!-- hidden <b> -->y": "x y",
        "x<script>var a = '</p>';</script >y": "x y",
        "x<STYLE>p {}</style>y": "x y",
        "x<script>never closed": "x",
        "<!DOCTYPE html><?xml version='1'?>x</ b>y": "x y",
        "<p>2 < 3 and <b": "2 < 3 and <b",
        "<p>a&nbsp;&middot;&nbsp;b</p>": "a · b",
        None: "",
        "": "",
    }
    assert column(normalize_review_text, list(cases)) == list(cases.values())


def test_clean_html_decodes_first(column):
    tidy = lambda c: normalize_whitespace(clean_html(c))
    assert column(tidy, ["&lt;b&gt;x", "a &amp; b", "&amp;amp;", None, "plain"]) == [
        "x",
        "a & b",
        "&",
        None,
        "plain",
    ]


def test_strip_html_keeps_spacing(column):
    assert column(strip_html, ["a<b>c", "no tags", None]) == ["a c", "no tags", None]


def test_duplicate_form_keeps_markup(column):
    assert column(normalize_for_duplicate, [None, "  <b> a ", "x\t\ny"]) == ["", "<b> a", "x y"]


def test_rating_table(column):
    cases = {
        "5": 5,
        " 5 ": 5,
        "5.0": 5,
        "5e0": 5,
        "5.": 5,
        ".5e1": 5,
        "+4": 4,
        "5\n": 5,
        "\t4": 4,
        "7": None,
        "0": None,
        "-1": None,
        "2.5": None,
        "nan": None,
        "inf": None,
        "0x5": None,
        "true": None,
        "": None,
        None: None,
        "5d": None,
        "5f": None,
        "1e999": None,
        "0_5": None,
    }
    assert column(validate_rating, list(cases)) == list(cases.values())


def test_rating_types(column):
    assert column(validate_rating, [True, False, None], "boolean") == [None, None, None]
    assert column(validate_rating, [5.0, 2.5, float("nan"), None], "double") == [5, None, None, None]
    assert column(validate_rating, [1, 6], "long") == [1, None]


@RELAXED
@given(
    st.lists(
        st.from_regex(r"[ \t]?[+-]?[0-9]{0,2}[.]?[0-9]{0,2}([eE][+-]?[0-9])?[ \n]?", fullmatch=True),
        min_size=30,
        max_size=60,
    )
)
def test_rating_equals_python_float(column, texts):
    def want(text):
        try:
            number = float(text)
        except ValueError:
            return None
        return int(number) if number in (1, 2, 3, 4, 5) else None

    assert column(validate_rating, texts) == [want(t) for t in texts]


def test_hash_equals_hashlib(spark):
    rows = [
        ("B1", "U1", "5", " Title  one ", "some\ttext"),
        (" B1 ", "U1", "5", "Title one", " some text "),
        ("B1", "U1", "5", "Title one", "other text"),
        (None, None, None, None, None),
        ("B|1", "é", "4", "ü", "日本"),
    ]
    names = ["asin", "user_id", "rating", "title", "text"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).coalesce(1)
    got = [r.h for r in df.select(review_hash(*[F.col(n) for n in names]).alias("h")).collect()]

    def want(row):
        asin, user, stars, title, text = ["" if v is None else v for v in row]
        canonical = (
            f"asin={asin.strip()}|user_id={user.strip()}|rating={stars.strip()}|"
            f"title={' '.join(title.split())}|text={' '.join(text.split())}"
        )
        return hashlib.sha256(canonical.encode()).hexdigest()

    assert got == [want(r) for r in rows]
    assert got[0] == got[1] != got[2]


def test_key_digest_tells_parts_and_nulls_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "c"), ("", "c"), ("-", "c"), ("1:a", ""), ("a", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    digests = df.select(key_digest([F.col("a"), F.col("b")]).alias("d")).collect()
    assert len({bytes(r.d) for r in digests}) == len(rows)
