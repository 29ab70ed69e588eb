"""Fixed values that results depend on."""

# File extensions of the item scan and the extra ones of the browse view.
ITEM_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")
BROWSE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp")

# Content type by extension; anything else is served as JPEG.
CONTENT_TYPES = {
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".webp": "image/webp",
    ".gif": "image/gif",
    ".bmp": "image/bmp",
}
DEFAULT_CONTENT_TYPE = "image/jpeg"

# Label of each score.
SCORE_LABELS = {
    1: "极差",
    2: "差",
    3: "较差",
    4: "一般-",
    5: "一般",
    6: "一般+",
    7: "较好",
    8: "好",
    9: "极好",
}

# Addresses of creators and collections in links.
CREATOR_LINK = r"/girl/(\d+)"
COLLECTION_LINK = r"/album/(\d+)"

# Thresholds.
FALLBACK_SCORE = 5
TITLE_LENGTH = 50
SAMPLE_COUNT = 8
ROW_OVERHEAD_BYTES = 2000
SHARD_MB = 200
CLUSTER_THRESHOLD = 0.5
MIN_CLUSTER_ITEMS = 3
MIN_SEQUENCE_ITEMS = 30
MIN_SEQUENCE_FEATURES = 10
ABRUPT_THRESHOLD = 0.85
SUSTAINED_THRESHOLD = 0.7
SUSTAINED_WINDOW = 5
FILLER_RATIO = 0.7
HISTOGRAM_EPSILON = 1e-7

# Quarantine categories.
CATEGORIES = ("non_main", "broken", "watermark", "blur", "duplicate")

# Letters counted by the text histogram.
LETTERS = "abcdefghijklmnopqrstuvwxyzé"

# White space as Python's str.strip() sees it (ASCII, NEL, NBSP and Unicode spaces).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The same white space as a regular-expression class.
SPACE_CLASS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

# A name in a title, after a bracket or at its start; the white space is the class above.
NAME_AFTER_BRACKET = rf"\][{SPACE_CLASS}]*([^\[\]]+?)(?:[{SPACE_CLASS}]*[-_][{SPACE_CLASS}]*|[{SPACE_CLASS}]+[A-Za-z])"
NAME_AT_START = rf"^([^\[\]\-_]+?)(?:[{SPACE_CLASS}]*[-_][{SPACE_CLASS}]*|[{SPACE_CLASS}]+[A-Za-z0-9])"

# Description of a sequence by type; {n} items, {k} key items.
SEQUENCE_TEXT = {
    "stepwise": ("type=stepwise; items={n}; key_items={k}", "类型=渐变；条目={n}；关键={k}"),
    "segmented": ("type=segmented; items={n}; segments={k}", "类型=分段；条目={n}；分段={k}"),
    "continuous": ("type=continuous; items={n}; key_items={k}", "类型=流动；条目={n}；关键={k}"),
    "minimal": ("type=minimal; items={n}; changes={k}", "类型=静态；条目={n}；变化={k}"),
    "random": ("type=random; items={n}", "类型=无序；条目={n}"),
}
DEFAULT_SEQUENCE_TEXT = ("items={n}", "条目={n}")

# Fallback rubric, used when no configuration file is given.
DEFAULT_RUBRIC = {
    "factors": {
        "clarity": {"weight": 0.30, "sub_factors": {"focus": 0.6, "noise": 0.4}},
        "lighting": {"weight": 0.20, "sub_factors": {"exposure": 0.5, "contrast": 0.5}},
        "composition": {"weight": 0.20, "sub_factors": {"balance": 0.7, "framing": 0.3}},
        "background": {"weight": 0.10, "sub_factors": {}},
        "relevance": {"weight": 0.20, "sub_factors": {}},
    },
    "modifier": {"key_frame_bonus": 0.2, "filler_penalty": -0.1},
    "tag_categories": {
        "place": ["indoor", "outdoor", "street", "studio"],
        "light": ["natural", "artificial", "backlit", "low-key"],
        "palette": ["warm", "cool", "monochrome", "vivid"],
    },
}
