"""Driver tables and the views over them, as DataFrames.

The driver tables hold no geography; these views give every operator scenes, observations, polygons,
lines, logs and manifests whose size follows the tables.
"""

from functools import cached_property

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions import spectral
from unitgrid.functions.grid import METRES_PER_DEGREE
from unitgrid.functions.numbers import round_half
from unitgrid.operators import contract, geometry, keys, zonal
from unitgrid.plans.night import night_long
from unitgrid.plans.sqlviews import BAND_EXPRESSIONS, DAY_FACTORS, HEXAGON, YEAR
from unitgrid.sources.readers import parse_image_names

SIZE = 64
PIXEL_M2 = 900.0
WIDE, FINE_M2 = 80, 100.0     # width and pixel area of images of odd blocks


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


class Views:
    def __init__(self, spark, sf_dir):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name):
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def unit(self):
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        seg = F.col("c_mktsegment")
        rk, nk, ck = F.col("r_regionkey") + 1, F.col("n_nationkey") + 1, F.col("c_custkey") + 1
        return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("c_custkey").alias("custkey"), _text("C.", rk, ".", nk, ".", ck, "_1").alias("gid_3"),
            _text("Đường ", F.col("c_name"), " Thủ").alias("name_3"),
            F.when(seg.isin("BUILDING", "MACHINERY"), "Phường").when(seg == "FURNITURE", "nan")
            .when(seg == "AUTOMOBILE", "Thị trấn").otherwise("Xã").alias("type_3"),
            _text("C.", rk, ".", nk, "_1").alias("gid_2"), _text("Huyện ", F.col("n_name")).alias("name_2"),
            _text("C.", rk, "_1").alias("gid_1"), _text("Tỉnh ", F.col("r_name")).alias("name_1")))

    @cached_property
    def admin(self):
        return self.unit.select(*S.ADMIN_COLUMNS)

    @cached_property
    def year_orders(self):
        """Orders of the index year, the range filter reaching the scan."""
        start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (YEAR, YEAR + 1))
        return self.table("orders").filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))

    @cached_property
    def unit_orders(self):
        return (self.year_orders.join(self.unit.select("custkey", "gid_3"), F.col("o_custkey") == F.col("custkey"))
                .withColumn("month", F.month("o_orderdate").cast("long")))

    @cached_property
    def month(self):
        return (self.unit_orders.groupBy("gid_3", "month")
                .agg(round_half(F.avg("o_totalprice") / 73331.0, 6).alias("val"), F.count("*").alias("n"))
                .select("gid_3", F.lit(YEAR).cast("long").alias("year"), "month", "val", "n"))

    @cached_property
    def day(self):
        return self.month.select("gid_3", "year", "month",
                                 *[F.expr(f"val * {k} AS {m}") for m, k in DAY_FACTORS.items()])

    @cached_property
    def px(self):
        return self.unit_orders.select(
            "gid_3", "month", (F.col("o_totalprice") / 73331.0).alias("avg_rad"),
            (F.col("o_orderkey") % 7).cast("double").alias("cf_cvg"),
            ((F.col("custkey") % 500 + 1) * 1.37).alias("area_ha"))

    @cached_property
    def long(self):
        return night_long(self.px)

    @cached_property
    def night(self):
        night = zonal.night_table(self.long, YEAR)
        return night.withColumns({c: round_half(c, 6) for c in ("TNL_MA3", S.GROWTH)})

    @cached_property
    def scene(self):
        e = self.table("events")
        k = F.get_json_object("props", "$.k").cast("int")
        left, low = F.col("event_id") * 37 % 1000, F.col("event_id") * 91 % 1000
        return e.select(F.col("event_id").alias("scene_id"), "ts", _text("U.", F.col("user_id")).alias("unit"),
                        F.col("event_type").alias("collection"), F.col("value").alias("cloud"),
                        (k * 64).alias("qa"), "user_id", (left * 1.0).alias("minx"), (low * 1.0).alias("miny"),
                        (left + 10.0).alias("maxx"), (low + 8.0).alias("maxy"))

    @cached_property
    def box(self):
        left, low = F.col("custkey") * 53 % 1000, F.col("custkey") * 29 % 1000
        return self.unit.select("gid_3", (left + 0.5).alias("minx"), (low + 0.5).alias("miny"),
                                (left + 6.5).alias("maxx"), (low + 5.5).alias("maxy"))

    @cached_property
    def obs(self):
        li = self.table("lineitem").withColumns({
            "row": F.col("l_orderkey") % SIZE, "col": F.col("l_partkey") % SIZE,
            "block": F.floor(F.col("l_suppkey") / 12)})
        qa = F.when(F.col("l_linenumber") == 7, 1024).when(F.col("l_linenumber") == 6, 2048).otherwise(0)
        return li.select(_text("img_", F.col("block")).alias("image_id"), "block", "row", "col",
                         F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber", qa.alias("qa"),
                         *[F.expr(f"CAST({e.format(d='div')} AS INT)").alias(b) for b, e in BAND_EXPRESSIONS.items()])

    @cached_property
    def image_size(self):
        """Size and resolution of every image; those of odd blocks are wider than their pixels and finer."""
        odd = F.col("block") % 2 == 1
        pick = lambda a, b, name: F.when(odd, a).otherwise(b).alias(name)
        return self.obs.select("image_id", "block").distinct().select(
            "image_id", F.lit(SIZE).alias("height"), pick(WIDE, SIZE, "width"), pick(FINE_M2, PIXEL_M2, "pixel_area_m2"), pick(10.0, 30.0, "res_m"))

    @cached_property
    def pixel(self):
        clear = self.obs.filter(spectral.is_clear("qa"))
        dn = zonal.composite(clear, ["image_id", "block", "row", "col"], S.REFLECTANCE_BANDS, digital=True, few=True)
        return spectral.scale_reflectance(dn, S.REFLECTANCE_BANDS)

    @cached_property
    def indexed(self):
        return spectral.add_indices(self.pixel)

    def _mask(self, table, predicate):
        return table.filter(spectral.valid_pixel() & predicate).select("image_id", "row", "col")

    @cached_property
    def road(self):
        return self._mask(self.indexed, spectral.road_mask())

    @cached_property
    def industrial(self):
        return self._mask(self.pixel, spectral.industrial_mask())

    @cached_property
    def water(self):
        return self._mask(self.pixel, spectral.water_mask())

    @cached_property
    def edge(self):
        ring = HEXAGON + HEXAGON[:1]
        sides = F.array(*[F.struct(F.lit(k).alias("k"), *[F.lit(float(v)).alias(n) for v, n in (
            (a[1], "dx1"), (a[0], "dy1"), (b[1], "dx2"), (b[0], "dy2"))]) for k, (a, b) in enumerate(zip(ring, ring[1:]))])
        s = F.col("s_suppkey")
        cy, cx = SIZE * F.floor(s / 12) + 8 + s * 7 % 48, 8 + s * 11 % 48
        return (self.table("supplier").select(_text("S.", s).alias("gid"), cx.alias("cx"), cy.alias("cy"),
                                              F.inline(sides))
                .select("gid", F.lit("0").alias("part"), F.lit(0).alias("ring"), "k",
                        (F.col("cx") + F.col("dx1")).alias("x1"), (F.col("cy") + F.col("dy1")).alias("y1"),
                        (F.col("cx") + F.col("dx2")).alias("x2"), (F.col("cy") + F.col("dy2")).alias("y2")))

    @cached_property
    def bounds(self):
        return geometry.bounds(self.edge)

    @cached_property
    def world(self):
        """All images on one grid, stacked by block."""
        return self.pixel.select((F.col("block") * SIZE + F.col("row")).alias("row"), "col", *S.REFLECTANCE_BANDS)

    @cached_property
    def point(self):
        e = self.table("events")
        way = F.floor(F.col("event_id") / 20)
        kind = F.when(F.col("event_type") == "click", "primary").when(F.col("event_type") == "view", "trunk")
        return e.select(way.alias("way_id"), (F.col("event_id") % 20).alias("seq"),
                        kind.otherwise("residential").alias("class"),
                        (F.col("event_id") * 17 % SIZE + 0.37).alias("x"),
                        (way % 8 * SIZE + F.col("event_id") * 29 % SIZE + 0.41).alias("y"))

    @cached_property
    def seg(self):
        return geometry.segments(self.point)

    @cached_property
    def status(self):
        e = self.table("events")
        k = F.get_json_object("props", "$.k").cast("long")
        kind = F.col("event_type")
        error = (F.when(k % 7 == 0, "HTTP 429 Too Many Requests")
                 .when(k % 7 == 1, "Total request size (9 bytes) must be less than or equal to 8 bytes")
                 .when(k % 7 == 2, "HTTP 403 Forbidden").when(k % 7 == 3, "").otherwise("read timed out"))
        return e.select(_text("U.", F.col("user_id")).alias("gid_3"), _text("run_", F.col("user_id") % 5).alias("run_id"),
                        F.col("event_id").alias("seq"), "ts",
                        F.when(kind == "purchase", "done").when(kind.isin("signup", "click"), "partial")
                        .otherwise("failed").alias("status"), (k % 5).alias("attempts"), error.alias("errors"))

    @cached_property
    def manifest(self):
        key = F.col("o_orderkey")
        o = self.table("orders").withColumn("kind_dir", F.when(key % 2 == 0, "Day").otherwise("Night"))
        day = F.col("kind_dir") == "Day"
        name = F.concat(F.when(key % 13 == 0, "Day").otherwise(F.col("kind_dir")), F.lit("/"), F.col("gid_1"), F.lit("/"),
                        F.replace("gid_3", F.lit("."), F.lit("_")), F.lit("_"), F.lower("kind_dir"), F.lit("_"),
                        F.year("o_orderdate").cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"),
                        F.lit(".tif"))
        other = F.concat(F.col("kind_dir"), F.lit("/plan_"), key.cast("string"), F.lit(".json"))
        step = F.when(key % 23 == 0, 1.02).otherwise(1.0) * F.when(day, 20).otherwise(500) / METRES_PER_DEGREE
        return (o.join(self.unit.select("custkey", "gid_1", "gid_3"), F.col("o_custkey") == F.col("custkey")).select(
            F.when(key % 11 == 0, other).otherwise(name).alias("path"), "o_orderkey",
            F.round(F.col("o_totalprice") * 100).cast("long").alias("size"), F.col("o_orderdate").alias("mtime"),
            _text("h", key % 97).alias("hash"), F.lit(1).cast("long").alias("version"),
            F.when(key % 17 == 0, 6).when(day, 10).otherwise(2).alias("bands"),
            F.when(key % 19 == 0, 3857).otherwise(4326).alias("epsg"), step.alias("step"),
            F.when(key % 29 == 0, "float32").when(key % 31 == 0, "int16").otherwise("float64").alias("dtype")))

    @cached_property
    def named(self):
        return parse_image_names(self.manifest, self.admin, YEAR)

    @cached_property
    def checked(self):
        return contract.check_images(self.named.withColumns({
            "step_x": F.col("step"), "step_y": -F.col("step"), "rot_x": F.lit(0.0), "rot_y": F.lit(0.0)}))

    @cached_property
    def images(self):
        return contract.image_states(self.checked)

    @cached_property
    def evidence(self):
        fields = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("field")) for i, f in enumerate(S.FIELDS)])
        units = keys.spread(self.admin.select("gid_3"), ["gid_3"])
        return keys.month_grid(units, YEAR).select("gid_3", "year", "month", F.inline(fields)).select(
            "gid_3", "year", "month", "field",
            ((F.length("gid_3") + F.col("month") + F.col("i")) % 4).cast("double").alias("count"))

    @cached_property
    def plan(self):
        grid = keys.spread(self.unit.select("custkey", "gid_3"), ["gid_3"]).withColumn("month", F.explode(F.array(*[F.lit(m).cast("long") for m in range(1, 13)])))
        k, m = F.col("custkey"), F.col("month")
        return grid.select("gid_3", "month", ((k + m) % 3).alias("c0"), ((k * 3 + m) % 4).alias("c1"),
                           ((k + m * 5) % 5).alias("c2"))

    @cached_property
    def day_full(self):
        return contract.normalize(self.day, self.admin, "day", YEAR)

    @cached_property
    def night_full(self):
        return contract.normalize(self.night, self.admin, "night", YEAR)
