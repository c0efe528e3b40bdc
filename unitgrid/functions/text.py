"""Names, slugs, natural keys, file names and error classes."""

import unicodedata

from pyspark.sql import functions as F

from unitgrid.functions.numbers import col

# Spellings that decide the class of an error message.
RATE_LIMIT_WORDS = ("429", "too many requests", "concurrency limit", "rate limit", "quota exceeded",
                    "resource_exhausted", "resource exhausted")
TOO_LARGE_WORDS = ("must be less than or equal to", "request size", "too large", "request payload size",
                   "user memory limit", "pixel grid dimensions")
PERMANENT_WORDS = ("401", "403", "forbidden", "unauthorized", "permission denied", "permission_denied",
                   "not authorized", "caller does not have permission")
IMAGE_NAME = r"^(.+)_(day|night)_{year}(0[1-9]|1[0-2])\.tif$"


def _letter_table():
    """Accented Latin letters and their base letters, from the Unicode decomposition rule."""
    pairs = {}
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letters = [c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c)]
        if len(letters) == 1 and letters[0] != chr(code):
            pairs[chr(code)] = letters[0]
    return "".join(pairs), "".join(pairs.values())


_ACCENTED, _PLAIN = _letter_table()


def strip_accents(c):
    """Drop combining marks, composed or not; the crossed d becomes a plain d."""
    bare = F.regexp_replace(F.translate(col(c), _ACCENTED, _PLAIN), "[̀-ͯ]", "")
    return F.translate(bare, "đĐ", "dD")


def slug(c, style="underscore"):
    """Accent-free name: `joined` (abc), `underscore` (a_b_c) or `camel` (ABC)."""
    plain = strip_accents(F.coalesce(col(c), F.lit("")))
    if style == "joined":
        return F.lower(F.regexp_replace(plain, "[^a-zA-Z0-9]", ""))
    if style == "underscore":
        return F.lower(F.trim(F.regexp_replace(plain, "[^a-zA-Z0-9]+", "_"), F.lit("_")))
    words = F.regexp_extract_all(plain, F.lit("([A-Za-z0-9]+)"), 1)
    camel = F.array_join(F.transform(words, F.initcap), "")
    return F.when(camel == "", "NA").otherwise(camel)


def natural_key(c):
    """Sortable key in which digit runs compare as numbers of any length."""
    parts = F.regexp_extract_all(col(c), F.lit(r"(\d+|\D+)"), 1)

    def element(part):
        digits = F.regexp_replace(part, "^0+(?=.)", "")
        number = part.rlike(r"^\d")
        return F.struct(F.when(number, 0).otherwise(1).alias("kind"),
                        F.when(number, F.length(digits)).otherwise(0).alias("width"),
                        F.when(number, digits).otherwise(part).alias("text"))
    return F.transform(parts, element)


def full_name(kind="type_3", name="name_3"):
    """Unit type followed by name; an empty or `nan` type is left out."""
    kind, name = F.trim(F.coalesce(col(kind), F.lit(""))), F.trim(col(name))
    return F.when((kind != "") & (F.lower(kind) != "nan"), F.concat_ws(" ", kind, name)).otherwise(name)


def safe_gid(gid="gid_3"):
    return F.replace(col(gid), F.lit("."), F.lit("_"))


def unit_dir(kind, gid_1="gid_1", name_1="name_1", gid_3="gid_3", unit_name=None):
    """Day or Night folder of a unit: province folder, then unit folder."""
    unit_name = full_name() if unit_name is None else unit_name
    return F.concat(F.lit(kind.title() + "/"), col(gid_1), F.lit("_"), slug(name_1), F.lit("/"),
                    col(gid_3), F.lit("_"), slug(unit_name))


def image_name(gid, kind, year, month):
    """File name of one unit-month image."""
    return F.concat(safe_gid(gid), F.lit("_"), col(kind), F.lit("_"), time_stamp(year, month, ""), F.lit(".tif"))


def province_prefix(kind, gid_1="gid_1"):
    return F.concat(F.lit(f"{kind}_csv_"), F.replace(col(gid_1), F.lit("."), F.lit("-")))


def group_prefix(kind, year, month, window=None):
    """Export name of a (month, window) group of images."""
    base = F.concat(F.lit(f"{kind}_img_"), time_stamp(year, month, ""))
    return base if window is None else F.concat(base, F.lit("_w"), col(window).cast("string"))


def stem(name_1="name_1", gid_3="gid_3", unit_name=None):
    """File stem with CamelCase province and unit names."""
    unit_name = full_name() if unit_name is None else unit_name
    return F.concat_ws("_", slug(name_1, "camel"), slug(unit_name, "camel"), col(gid_3))


def time_stamp(year="year", month="month", sep="-"):
    """YYYY-MM (or another separator)."""
    return F.concat(col(year).cast("string"), F.lit(sep), F.lpad(col(month).cast("string"), 2, "0"))


def has_any(c, words):
    low = F.lower(F.coalesce(col(c), F.lit("")))
    hit = F.lit(False)
    for word in words:
        hit = hit | low.contains(word)
    return hit


def is_rate_limited(c):
    return has_any(c, RATE_LIMIT_WORDS)


def error_class(c):
    """rate_limited, too_large, permanent or transient."""
    return (F.when(is_rate_limited(c), "rate_limited").when(has_any(c, TOO_LARGE_WORDS), "too_large")
            .when(has_any(c, PERMANENT_WORDS), "permanent").otherwise("transient"))
