"""Names, limits and tables that results depend on.

Nothing here is tuning; changing a value changes what the operators return.
"""

# Row and text limits.
MIN_REVIEW_COUNT = 10_000
MIN_TEXT_LENGTH = 3
VALID_RATINGS = (1, 2, 3, 4, 5)

# Language policy.
TARGET_LANGUAGE = "en"
KEEP_UNDETECTABLE = False
PROFILE_SIZE = 300

# Column aliases, in order of preference.
TEXT_ALIASES = (
    "text",
    "reviewtext",
    "review_text",
    "review_body",
    "reviewbody",
    "review",
    "body",
    "content",
    "comment",
)
RATING_ALIASES = ("rating", "overall", "stars", "score")

# Column names that point to review data and to product metadata.
REVIEW_LIKE_FIELDS = TEXT_ALIASES + RATING_ALIASES + ("user_id", "reviewerid", "reviewer_id")
METADATA_LIKE_FIELDS = (
    "title",
    "brand",
    "price",
    "description",
    "rank",
    "main_cat",
    "category",
    "categories",
    "image",
    "images",
)

# Rejection reasons, in the order in which the checks run.
EMPTY_OR_TOO_SHORT = "empty_or_too_short"
MISSING_TEXT = "missing_text"
EMPTY_TEXT = "empty_text"
INVALID_RATING = "invalid_rating"
UNDETECTABLE_LANGUAGE = "undetectable_language"
NON_ENGLISH = "non_english"
REASONS = (EMPTY_OR_TOO_SHORT, INVALID_RATING, UNDETECTABLE_LANGUAGE, NON_ENGLISH)
SPLIT_REASONS = (MISSING_TEXT, EMPTY_TEXT) + REASONS

# Character references that are decoded. `&amp;` is not in the table because it
# has to be decoded after all others, or `&amp;lt;` would be decoded twice.
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&iexcl;", "¡"),
    ("&cent;", "¢"),
    ("&pound;", "£"),
    ("&sect;", "§"),
    ("&copy;", "©"),
    ("&laquo;", "«"),
    ("&reg;", "®"),
    ("&deg;", "°"),
    ("&plusmn;", "±"),
    ("&middot;", "·"),
    ("&raquo;", "»"),
    ("&frac12;", "½"),
    ("&iquest;", "¿"),
    ("&times;", "×"),
    ("&eacute;", "é"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&lsquo;", "‘"),
    ("&rsquo;", "’"),
    ("&ldquo;", "“"),
    ("&rdquo;", "”"),
    ("&bull;", "•"),
    ("&hellip;", "…"),
    ("&euro;", "€"),
    ("&trade;", "™"),
    ("&#34;", '"'),
    ("&#39;", "'"),
    ("&#60;", "<"),
    ("&#62;", ">"),
    ("&#160;", "\u00a0"),
    ("&#8211;", "–"),
    ("&#8212;", "—"),
    ("&#8216;", "‘"),
    ("&#8217;", "’"),
    ("&#8220;", "“"),
    ("&#8221;", "”"),
    ("&#8230;", "…"),
    ("&#x27;", "'"),
    ("&#x2F;", "/"),
)
AMPERSAND_FORMS = ("&#38;", "&amp;")
