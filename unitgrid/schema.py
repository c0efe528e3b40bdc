"""Table contracts: column names, state names and Spark schemas."""

from pyspark.sql import types as T

# Column names, state names and messages that appear in result tables.
ADMIN_COLUMNS = ["gid_3", "name_3", "type_3", "gid_2", "name_2", "gid_1", "name_1"]
KEY = ["gid_3", "year", "month"]
PREFIX = ADMIN_COLUMNS + ["year", "month"]
DAY_BANDS = ["BLUE", "GREEN", "RED", "NIR", "SWIR1", "SWIR2", "NDVI", "NDBI", "MNDWI", "BSI"]
REFLECTANCE_BANDS = DAY_BANDS[:6]
DAY_METRICS = [f"{band}_{stat}" for band in DAY_BANDS for stat in ("mean", "stdDev")]
NIGHT_METRICS = [
    "TIME", "COMMUNE_AREA_HA", "TNL", "MEAN_RAD", "STD_RAD", "MIN_RAD", "MAX_RAD", "SPATIAL_CV",
    "LIT_PIXELS", "LIT_AREA_HA", "ELECTRIFICATION_RATIO_PCT", "LIT_POP_PROXY", "CLOUD_FREE_OBS",
    "TNL_MA3", "TNL_MOM_GROWTH_PCT",
]
GROWTH = "TNL_MOM_GROWTH_PCT"
NIGHT_EXPORT_KEYS = [
    "avg_rad_sum", "avg_rad_mean", "avg_rad_stdDev", "avg_rad_min", "avg_rad_max", "avg_rad_count",
    "lit_rad", "is_lit", "cf_cvg",
]
FIELDS = ["day_image", "day_indices", "night_image", "night_indices"]
TERMINAL = ["done", "no_source"]
STATES = ["pending", "running", "done", "no_source", "failed"]
EXPECTED_UNITS = 11163
YEAR = 2024

MSG_MISSING = "Chỉ số thiếu hoặc không hữu hạn"
MSG_NO_METRICS = "Chưa có chỉ số; chưa có bằng chứng nguồn rỗng"
MSG_TIME = "TIME không khớp year/month"
MSG_ZERO_SOURCE = "Nguồn rỗng nhưng CSV có chỉ số"
MSG_NO_IMAGE = "Chưa có ảnh"
MSG_INTERRUPTED = "Lượt trước bị ngắt; cần chạy tiếp"
MSG_SEVERAL_FILES = "Có nhiều file cùng xã/tháng"
MSG_BANDS_CRS = "Số kênh hoặc CRS không đúng"
MSG_RESOLUTION = "Độ phân giải/lưới không đúng"
MSG_NIGHT_DTYPE = "Ảnh đêm cần float64"
MSG_DAY_DTYPE = "Ảnh ngày cần dữ liệu float, 10 kênh"
MSG_NO_GEOMETRY = "Không có ranh giới trong asset"
MSG_TILES_MISSING = "Không đủ ô export phủ ranh giới xã"
NOTE_SCHEMA, NOTE_MONTHS, NOTE_KEY = "Sai schema/thứ tự cột", "Phải có đúng 12 tháng", "Năm sai hoặc trùng khóa"
NOTE_CSV_GOOD, NOTE_IMAGES_GOOD = "12 tháng, đủ cột", "đọc được, đúng kênh/CRS/độ phân giải"
VERDICT_GRID, VERDICT_SAME = "KHÁC LƯỚI", "KHỚP"
VERDICT_VALUES, VERDICT_DISJOINT = "LỆCH GIÁ TRỊ", "KHÔNG CHỒNG"

METRICS = {"day": DAY_METRICS, "night": NIGHT_METRICS}
COLUMNS = {kind: PREFIX + metrics for kind, metrics in METRICS.items()}


def metric_type(name):
    """Spark type of one metric column."""
    if name == "TIME":
        return T.StringType()
    return T.LongType() if name == "LIT_PIXELS" else T.DoubleType()


def _struct(pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


ADMIN_SCHEMA = _struct([(c, T.StringType()) for c in ADMIN_COLUMNS])
SOURCES_SCHEMA = _struct([("gid_3", T.StringType()), ("year", T.LongType()), ("month", T.LongType()),
                          ("field", T.StringType()), ("count", T.DoubleType())])
STATUS_SCHEMA = _struct([
    ("gid_3", T.StringType()), ("run_id", T.StringType()), ("seq", T.LongType()), ("ts", T.StringType()),
    ("status", T.StringType()), ("attempts", T.LongType()), ("errors", T.ArrayType(T.StringType())),
    ("t2", T.MapType(T.StringType(), T.StringType())),
    ("t3img", T.MapType(T.StringType(), T.StringType())),
])
IMAGES_SCHEMA = _struct([("kind", T.StringType()), ("gid_3", T.StringType()), ("month", T.LongType()),
                         ("state", T.StringType()), ("error", T.StringType())])


def index_schema(kind):
    """Schema of an index table, `kind` being day or night."""
    return _struct([(c, T.StringType()) for c in ADMIN_COLUMNS]
                   + [("year", T.LongType()), ("month", T.LongType())]
                   + [(m, metric_type(m)) for m in METRICS[kind]])


def progress_schema():
    return _struct([(c, T.StringType()) for c in ADMIN_COLUMNS]
                   + [("year", T.LongType()), ("month", T.LongType())]
                   + [(c, T.StringType()) for f in FIELDS for c in (f, f + "_error")])
