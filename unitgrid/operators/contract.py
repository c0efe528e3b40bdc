"""The data contract: normalising index tables, states, gates and repairs.

Every rule has a function that returns its violations as a DataFrame; `enforce` turns a non-empty
one into an error, reading at most ten rows.
"""

from functools import reduce

from pyspark.sql import functions as F

from unitgrid import schema as S
from unitgrid.functions.numbers import as_double, is_bad_number, is_finite, is_numeric
from unitgrid.functions.text import natural_key, time_stamp
from unitgrid.operators.keys import drop_exact, duplicate_keys, enrich_admin, month_grid, one_per_key, placed, unknown_keys
from unitgrid.session import materialize


class ContractError(ValueError):
    """A table breaks its contract."""


def enforce(violations, what):
    rows = violations.limit(10).collect()
    if rows:
        raise ContractError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def _tagged(df, check, detail):
    return df.select(F.lit(check).alias("check"), detail.cast("string").alias("detail"))


# --- columns -----------------------------------------------------------------------------------

def _alias_groups(columns):
    """Positions of the columns that share a contract name, lower-case spelling first."""
    groups = {}
    for i, name in enumerate(columns):
        groups.setdefault(name.lower() if name.lower() in S.PREFIX else name, []).append(i)
    return {new: sorted(at, key=lambda i: columns[i] != new) for new, at in groups.items()}


def unify_aliases(df):
    """Old upper-case identifier columns become the contract's; where both exist values are merged."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.coalesce(*[F.col(f"_c{i}") for i in at]).alias(new)
                         for new, at in _alias_groups(df.columns).items()])


def _has_two_spellings(df):
    return any(len(at) > 1 for at in _alias_groups(df.columns).values())


def _clashes(columns):
    """(name, differs) for every pair of spellings, over columns renamed to _c0, _c1, ..."""
    return [(new, F.coalesce(F.col(f"_c{at[0]}").cast("string") != F.col(f"_c{i}").cast("string"), F.lit(False)))
            for new, at in _alias_groups(columns).items() for i in at[1:]]


def _alias_clash(columns):
    return reduce(lambda a, b: a | b, [differs for _, differs in _clashes(columns)])


def alias_conflicts(df):
    """Rows in which two spellings of one column hold different values."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    bad = [F.when(differs, F.lit(new)) for new, differs in _clashes(df.columns)]
    found = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return _tagged(flat.filter(F.size(found) > 0), "alias", F.array_join(found, ","))


def strict_double(df, columns):
    """Cast to double with NaN as NULL; texts that are not numbers are reported by bad_numbers."""
    return df.withColumns({c: as_double(df, c) for c in columns if c in df.columns})


def bad_numbers(df, columns):
    """Non-null values that are not numbers, one row per offending row."""
    texts = [c for c in columns if c in df.columns and not is_numeric(df, c)]
    found = F.array_compact(F.array(*[F.when(is_bad_number(F.col(c).cast("string")), F.lit(c)) for c in texts])
                            ) if texts else F.array().cast("array<string>")
    return _tagged(df.filter(F.size(found) > 0), "number", F.array_join(found, ","))


def conform(df, kind):
    """Exactly the contract's columns, in order; absent ones NULL, others dropped."""
    present = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in S.index_schema(kind)])


def _outside(year):
    number = lambda c: F.col(c).cast("string").try_cast("double")
    return (F.col("gid_3").isNull() | ~F.coalesce(number("year") == year, F.lit(False))
            | ~F.coalesce(number("month").isin(*[float(m) for m in range(1, 13)]), F.lit(False)))


def domain_violations(df, year):
    """Rows with a blank gid or outside the year and its months."""
    return _tagged(df.filter(_outside(year)), "domain", F.concat_ws("/", "gid_3", F.col("year").cast("string"),
                                                         F.col("month").cast("string")))


# --- administrative table ------------------------------------------------------------------------

def admin_violations(admin, expected=S.EXPECTED_UNITS):
    """Blank fields, duplicated gids and a wrong number of units."""
    blank = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.col(c) == "") for c in S.ADMIN_COLUMNS])
    parts = [_tagged(admin.filter(blank), "blank", F.coalesce("gid_3", F.lit("?"))),
             _tagged(duplicate_keys(admin, ["gid_3"]), "duplicate", F.col("gid_3"))]
    if expected is not None:
        total = admin.agg(F.count("*").alias("n")).filter(F.col("n") != expected)
        parts.append(_tagged(total, "count", F.concat_ws(" of ", F.col("n").cast("string"), F.lit(str(expected)))))
    return reduce(lambda a, b: a.union(b), parts)


def check_admin(admin, expected=S.EXPECTED_UNITS):
    """The unit table with contract columns, or an error."""
    admin = unify_aliases(admin)
    missing = set(S.ADMIN_COLUMNS) - set(admin.columns)
    if missing:
        raise ContractError(f"administrative table lacks {sorted(missing)}")
    admin = admin.select(*[F.col(c).cast("string").alias(c) for c in S.ADMIN_COLUMNS])
    enforce(admin_violations(admin, expected), "administrative table")
    return admin


# --- normalising ---------------------------------------------------------------------------------

def _numeric(kind):
    return [m for m in S.METRICS[kind] if m != "TIME"]


def guard(bad, message):
    """Filter condition that stops the job at the first bad row; costs no pass of its own."""
    return F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _typed(df, kind):
    """Key and metric columns as text and doubles; whole-number metrics get their type after conflicts are looked for."""
    df = unify_aliases(df)
    lacking = set(S.KEY) - set(df.columns)
    if lacking:
        raise ContractError(f"table lacks {sorted(lacking)}")
    metrics = [m for m in S.METRICS[kind] if m in df.columns]
    out = strict_double(df.select(*S.KEY, *metrics), [m for m in metrics if m != "TIME"])
    return out.select(F.col("gid_3").cast("string").alias("gid_3"),
                      *[as_double(df, c).cast("long").alias(c) for c in ("year", "month")],
                      *[(F.col(m) if m in metrics else F.lit(None)).cast("string" if m == "TIME" else "double").alias(m)
                        for m in S.METRICS[kind]])


def _row_problems(df, kind, year):
    """Array of the checks a raw row fails: alias, domain, number."""
    flat = unify_aliases(df)
    texts = [m for m in _numeric(kind) if m in flat.columns and not is_numeric(flat, m)]
    bad_text = reduce(lambda a, b: a | b, [is_bad_number(m) for m in texts], F.lit(False))
    return F.array_compact(F.array(F.when(_outside(year), "domain"), F.when(bad_text, "number")))


def _collapsed(df, kind, year):
    """One row per (gid_3, month): exact duplicates collapse, conflicting ones stop the job.

    The group-by combines before the shuffle and leaves rows placed by (gid_3, month) for the joins
    that follow. NULL takes part as NaN (text: as the empty text), so NULL against a value is a conflict.
    """
    if _has_two_spellings(df):
        flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
        df = flat.filter(guard(_alias_clash(df.columns), F.lit("alias: two spellings disagree"))).toDF(*df.columns)
    flat = unify_aliases(df)
    where = F.concat_ws("/", *[F.col(c).cast("string") for c in S.KEY if c in flat.columns])
    lacking = set(S.KEY) - set(flat.columns)
    if lacking:
        raise ContractError(f"table lacks {sorted(lacking)}")
    problems = _row_problems(flat, kind, year)
    rows = _typed(flat.filter(guard(F.size(problems) > 0, F.concat(F.array_join(problems, ","), F.lit(" at "), where))), kind)
    fill = {m: "''" if m == "TIME" else "double('NaN')" for m in S.METRICS[kind]}
    lows = [F.expr(f"min(coalesce(`{m}`, {fill[m]})) AS `_lo_{m}`") for m in S.METRICS[kind]]
    highs = [F.expr(f"max(coalesce(`{m}`, {fill[m]})) AS `_hi_{m}`") for m in S.METRICS[kind]]
    clash = F.expr(" OR ".join(f"`_lo_{m}` <> `_hi_{m}`" for m in S.METRICS[kind]))
    grouped = rows.groupBy("gid_3", "month").agg(*lows, *highs).filter(
        guard(clash, F.concat(F.lit("conflict at "), F.concat_ws("/", "gid_3", F.col("month").cast("string")))))
    return grouped.select("gid_3", F.lit(year).cast("long").alias("year"), "month",
                          *[F.expr(f"nullif(`_lo_{m}`, {fill[m]})").cast(S.metric_type(m)).alias(m)
                            for m in S.METRICS[kind]])


def normalize_violations(df, admin, kind, year=S.YEAR):
    """Everything that makes an index table unacceptable, as (check, detail) rows.

    Row rules need one scan; unknown gids and conflicting duplicates one aggregation each.
    """
    flat = unify_aliases(df)
    rows = drop_exact(_typed(df, kind))
    where = F.concat_ws("/", "gid_3", F.col("year").cast("string"), F.col("month").cast("string"))
    broken = flat.select(F.explode(_row_problems(flat, kind, year)).alias("check"), where.alias("detail"))
    parts = [broken, _tagged(unknown_keys(flat, admin), "unknown", F.col("gid_3")),
             _tagged(duplicate_keys(rows, S.KEY), "conflict", F.concat_ws("/", "gid_3", "month"))]
    if _has_two_spellings(df):
        parts.append(alias_conflicts(df))
    return reduce(lambda a, b: a.union(b), parts)


def normalize(df, admin, kind, year=S.YEAR, complete=True):
    """Contract table: names by gid, exact duplicates collapsed, twelve rows per unit if `complete`.

    Broken rows, conflicting duplicates and unknown gids stop the job while it runs: all rules are part
    of the one plan. `normalize_violations` lists them instead. Units are counted once, for their placement and that of their months.
    """
    rows = _collapsed(df, kind, year)
    unknown = lambda marker: guard(F.col(marker).isNull(), F.concat(F.lit("unknown gid "), F.col("gid_3")))
    units = admin.count()
    admin = one_per_key(placed(admin.select(*S.ADMIN_COLUMNS), ["gid_3"], units), ["gid_3"], "administrative table")
    if not complete:
        return conform(enrich_admin(rows, admin).filter(unknown("gid_1")), kind)
    grid = placed(month_grid(admin, year, columns=S.ADMIN_COLUMNS), ["gid_3", "month"], 12 * units)
    return conform(grid.join(rows.drop("year"), ["gid_3", "month"], "full").filter(unknown("gid_1")), kind)


def natural_sorted(df, tasks=None):
    """Contract row order: natural gid, name, year, month (a range sort, into `tasks` ranges if given)."""
    order, keyed = ["_key", "name_3", "year", "month"], df.withColumn("_key", natural_key("gid_3"))
    if tasks is not None:
        return keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("_key")
    return keyed.orderBy(*order).drop("_key")


# --- states ----------------------------------------------------------------------------------------

def read_source_rules(sources, year=S.YEAR):
    """Violations of the source-count table."""
    bad = (F.col("gid_3").isNull() | ~F.coalesce(F.col("year") == year, F.lit(False))
           | ~F.coalesce(F.col("month").between(1, 12), F.lit(False))
           | ~F.coalesce(F.col("field").isin(*S.FIELDS), F.lit(False))
           | ~is_finite("count") | (F.col("count") < 0))
    key = S.KEY + ["field"]
    return _tagged(sources.filter(bad), "source", F.concat_ws("/", "gid_3", F.col("month").cast("string"), "field")
                   ).union(_tagged(duplicate_keys(drop_exact(sources), key), "conflict",
                                   F.concat_ws("/", "gid_3", F.col("month").cast("string"), "field")))


def _zero_flags(sources):
    """One row per (gid, month) with a zero-count flag per field; combines before the shuffle.

    Evidence that contradicts itself, counts that are negative or not finite, and unknown fields stop the job.
    """
    own = lambda f: F.when(F.col("field") == f, F.col("count"))
    wrong = F.coalesce(~is_finite("count") | (F.col("count") < 0) | ~F.col("field").isin(*S.FIELDS), F.lit(True))
    flags = sources.groupBy("gid_3", "month").agg(
        F.bool_or(wrong).alias("_wrong"), *[F.min(own(f)).alias(f"_lo_{f}") for f in S.FIELDS], *[F.max(own(f)).alias(f"_hi_{f}") for f in S.FIELDS])
    split = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"_lo_{f}") != F.col(f"_hi_{f}"), F.lit(False)) for f in S.FIELDS])
    where = F.concat_ws("/", "gid_3", F.col("month").cast("string"))
    return flags.filter(guard(F.col("_wrong") | split, F.concat(F.lit("source evidence at "), where))).select(
        "gid_3", "month", *[F.coalesce(F.col(f"_lo_{f}") == 0, F.lit(False)).alias(f"_zero_{f}") for f in S.FIELDS])


def _facts(kind, year):
    """What a row's state depends on besides its evidence: whether it is empty, has holes, has another TIME."""
    def hole(m):
        plain = f"`{m}` IS NULL"
        if S.metric_type(m).typeName() != "double":
            return plain
        return f"{plain} OR isnan(`{m}`) OR abs(`{m}`) = double('inf')"
    all_empty = F.expr(" AND ".join(f"`{m}` IS NULL" for m in S.METRICS[kind]))
    broken = F.expr(" OR ".join(hole(m) for m in S.METRICS[kind] if m != S.GROWTH))
    wrong_time = ~F.col("TIME").eqNullSafe(time_stamp(F.lit(year), "month")) if kind == "night" else F.lit(False)
    return {"_empty": all_empty, "_broken": broken, "_late": wrong_time}


def _state_columns(kind, facts):
    """(state, error) columns of a table that carries its _zero_* flag, from its facts."""
    zero = F.coalesce(F.col(f"_zero_{kind}_indices"), F.lit(False))
    cases = [(zero & facts["_empty"], "no_source", ""), (zero, "failed", S.MSG_ZERO_SOURCE),
             (facts["_empty"], "pending", S.MSG_NO_METRICS), (facts["_late"], "failed", S.MSG_TIME),
             (facts["_broken"], "failed", S.MSG_MISSING)]
    chain = lambda pick, last: reduce(lambda acc, c: F.when(c[0], F.lit(c[pick])).otherwise(acc),
                                      reversed(cases), F.lit(last))
    return chain(1, "done"), chain(2, "")


def _with_states(table, kind, zeros, year):
    state, error = _state_columns(kind, _facts(kind, year))
    return table.join(zeros, ["gid_3", "month"], "left").withColumns({"state": state, "error": error})


def _key_states(table, kind, zeros, year, rows=0):
    """Key, state and error per row. The facts are taken first, so that no metric goes through the join; `rows`, about their number, places them."""
    facts = _facts(kind, year)
    narrow = table.select(*S.KEY, *[c.alias(name) for name, c in facts.items()])
    state, error = _state_columns(kind, {name: F.col(name) for name in facts})
    return placed(narrow, ["gid_3", "month"], rows).join(zeros.select("gid_3", "month", f"_zero_{kind}_indices"), ["gid_3", "month"], "left").select(*S.KEY, state.alias("state"), error.alias("error"))


def metric_states(table, kind, sources, year=S.YEAR):
    """State and error per row of a normalised table, given source evidence."""
    return _key_states(table, kind, _zero_flags(sources), year)


def merge_valid(old, incoming, admin, kind, sources, year=S.YEAR):
    """Incoming rows replace only rows that are not done or source-less; valid old values stay."""
    prior = _with_states(normalize(old, admin, kind, year), kind, _zero_flags(sources), year)
    new = normalize(incoming, admin, kind, year, complete=False)
    new = new.select("gid_3", "month", F.lit(True).alias("_new"), *[F.col(m).alias(f"_n_{m}") for m in S.METRICS[kind]])
    replace = ~F.col("state").isin(*S.TERMINAL) & F.col("_new").isNotNull()
    merged = prior.join(new, ["gid_3", "month"], "left").withColumns(
        {m: F.when(replace, F.col(f"_n_{m}")).otherwise(F.col(m)) for m in S.METRICS[kind]})
    return conform(merged, kind)


def _image_states(images):
    """Day and night image state side by side per (gid, month)."""
    picks = []
    for kind in ("day", "night"):
        own = F.col("kind") == kind
        picks += [F.max(F.when(own, F.struct("state", "error"))).alias(f"_img_{kind}")]
    return images.groupBy("gid_3", "month").agg(*picks)


def progress(admin, day, night, images, sources, previous=None, year=S.YEAR):
    """State of the four fields per unit and month.

    `day` and `night` are index tables, checked like in `normalize`. Every input has one row per
    (gid, month) and is joined on that key, so the shuffles share one partitioning.
    """
    key = ["gid_3", "month"]
    table = month_grid(admin, year, columns=S.ADMIN_COLUMNS).join(_zero_flags(sources), key, "left").join(_image_states(images), key, "left")
    for kind, frame in (("day", day), ("night", night)):
        rows = _collapsed(frame, kind, year).select(*key, *S.METRICS[kind])
        table = table.join(rows, key, "full").filter(
            guard(F.col("gid_1").isNull(), F.concat(F.lit("unknown gid "), F.col("gid_3"))))
    states = {}
    for kind in ("day", "night"):
        states[f"{kind}_indices"], states[f"{kind}_indices_error"] = _state_columns(kind, _facts(kind, year))
        field, image = f"{kind}_image", F.col(f"_img_{kind}")
        waiting = F.coalesce(image["state"], F.lit("pending")) == "pending"
        empty = waiting & F.coalesce(F.col(f"_zero_{field}"), F.lit(False))
        states[field] = F.when(empty, "no_source").otherwise(F.coalesce(image["state"], F.lit("pending")))
        states[field + "_error"] = (F.when(empty, "").when(image.isNull(), S.MSG_NO_IMAGE)
                                    .otherwise(F.coalesce(image["error"], F.lit(""))))
    table = table.withColumns(states)
    if previous is not None:
        before = previous.select("gid_3", "year", "month", *[F.col(c).alias(f"_p_{c}")
                                                             for f in S.FIELDS for c in (f, f + "_error")])
        table = table.join(before, S.KEY, "left")
        for f in S.FIELDS:
            cut = (F.col(f) == "pending") & F.coalesce(F.col(f"_p_{f}").isin("running", "failed"), F.lit(False))
            note = F.coalesce(F.nullif(F.col(f"_p_{f}_error"), F.lit("")), F.lit(S.MSG_INTERRUPTED))
            table = table.withColumns({f + "_error": F.when(cut, note).otherwise(F.col(f + "_error")),
                                       f: F.when(cut, "failed").otherwise(F.col(f))})
    return table.select(*S.PREFIX, *[c for f in S.FIELDS for c in (f, f + "_error")])


def gate_violations(table, year=S.YEAR):
    """Unit-months or units that block the night phase: (gid_3, month, reason)."""
    row = lambda df, month, reason: df.select("gid_3", month.cast("long").alias("month"),
                                              F.lit(reason).alias("reason"))
    open_work = ~(F.col("day_image").isin(*S.TERMINAL) & F.col("day_indices").isin(*S.TERMINAL))
    outside = ~F.coalesce((F.col("year") == year) & F.col("month").between(1, 12), F.lit(False))
    units = table.groupBy("gid_3").agg(F.count_distinct("month").alias("m"))
    return (row(table.filter(F.coalesce(open_work, F.lit(True))), F.col("month"), "open")
            .union(row(table.filter(outside), F.col("month"), "domain"))
            .union(row(duplicate_keys(table, S.KEY), F.col("month"), "duplicate"))
            .union(row(units.filter("m <> 12"), F.lit(None), "months")))


def require_complete(table, year=S.YEAR):
    """Raise unless every unit-month of the day phase is finished."""
    if not table.take(1):
        raise ContractError("no inventory of the day phase")
    enforce(gate_violations(table, year), "night phase blocked")


def apply_updates(table, updates):
    """Set states and errors from (gid_3, month, field, state, error); finished states never change.

    A NULL month stands for every month. Two different updates of one (gid, month, field) stop the job.
    """
    def wide(df, key):
        pick = {f: F.when(F.col("field") == f, F.struct("state", "error")) for f in S.FIELDS}
        rows = df.groupBy(*key).agg(*[F.max(pick[f]).alias(f"_u_{f}") for f in S.FIELDS], *[F.min(pick[f]).alias(f"_v_{f}") for f in S.FIELDS])
        split = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"_u_{f}") != F.col(f"_v_{f}"), F.lit(False)) for f in S.FIELDS])
        where = F.concat_ws("/", *[F.col(k).cast("string") for k in key])
        return rows.filter(guard(split, F.concat(F.lit("several updates at "), where))).drop(*[f"_v_{f}" for f in S.FIELDS])
    by_month = wide(updates.filter(F.col("month").isNotNull()), ["gid_3", "month"])
    by_unit = wide(updates.filter(F.col("month").isNull()), ["gid_3"])
    by_unit = by_unit.withColumnsRenamed({f"_u_{f}": f"_a_{f}" for f in S.FIELDS})
    out = table.join(by_month, ["gid_3", "month"], "left").join(by_unit, "gid_3", "left")
    changes = {}
    for f in S.FIELDS:
        new = F.coalesce(F.col(f"_u_{f}"), F.col(f"_a_{f}"))
        hit = ~F.col(f).isin(*S.TERMINAL) & new.isNotNull()
        changes[f] = F.when(hit, new["state"]).otherwise(F.col(f))
        changes[f + "_error"] = F.when(hit, new["error"]).otherwise(F.col(f + "_error"))
    return out.withColumns(changes).select(*table.columns)


# --- images and verification -------------------------------------------------------------------------

def check_images(manifest):
    """State of each image from its metadata: bands, CRS, resolution within 1 %, no rotation, type.

    manifest: kind, bands, epsg, step_x, step_y, rot_x, rot_y, dtype plus any key columns.
    """
    from unitgrid.functions.grid import METRES_PER_DEGREE
    day = F.col("kind") == "day"
    scale = F.when(day, 20.0).otherwise(500.0)
    off = lambda c: F.abs(c * METRES_PER_DEGREE - scale) > scale * 0.01
    bad_bands = (F.col("bands") != F.when(day, 10).otherwise(2)) | ~F.coalesce(F.col("epsg") == 4326, F.lit(False))
    bad_grid = ((F.col("step_x") <= 0) | (F.col("step_y") >= 0) | (F.col("rot_x") != 0) | (F.col("rot_y") != 0)
                | off(F.col("step_x")) | off(-F.col("step_y")))
    known = lambda wrong: F.coalesce(wrong, F.lit(True))  # metadata that cannot be read is a failure
    error = (F.when(known(bad_bands), S.MSG_BANDS_CRS).when(known(bad_grid), S.MSG_RESOLUTION)
             .when(~day & known(F.col("dtype") != "float64"), S.MSG_NIGHT_DTYPE)
             .when(day & known(~F.col("dtype").startswith("float")), S.MSG_DAY_DTYPE).otherwise(""))
    return manifest.withColumn("error", error).withColumn("state", F.when(F.col("error") == "", "done")
                                                          .otherwise("failed"))


def image_states(checked):
    """One state per (kind, gid_3, month); several files for one unit-month are a failure."""
    return (checked.groupBy("kind", "gid_3", "month")
            .agg(F.count("*").alias("n"), F.max("state").alias("s"), F.max("error").alias("e"))
            .select("kind", "gid_3", "month",
                    F.when(F.col("n") > 1, "failed").otherwise(F.col("s")).alias("state"),
                    F.when(F.col("n") > 1, S.MSG_SEVERAL_FILES).otherwise(F.col("e")).alias("error")))


def verify_units(table, kind, sources, admin, year=S.YEAR):
    """Per unit: twelve months, year and key, finished states; PASS or FAIL with counts.

    Units come from the admin table, so a unit without rows is reported as well.
    """
    rows = _key_states(table, kind, _zero_flags(sources), year)
    per_key = rows.groupBy("gid_3", "year", "month").agg(
        F.count("*").alias("n"), F.count_if(~F.col("state").isin(*S.TERMINAL)).alias("open"))
    units = per_key.groupBy("gid_3").agg(
        F.sum("n").alias("rows"), F.count_distinct(F.when(F.col("month").between(1, 12), F.col("month"))).alias("months"),
        F.count_if((F.col("n") > 1) | (F.col("year") != year)).alias("bad_keys"), F.sum("open").alias("open"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    out = admin.select("gid_3").join(units, "gid_3", "left").select(
        "gid_3", zero("rows"), zero("months"), zero("bad_keys"), zero("open"))
    good = (F.col("rows") == 12) & (F.col("months") == 12) & (F.col("bad_keys") == 0) & (F.col("open") == 0)
    return out.withColumn("level", F.when(good, "PASS").otherwise("FAIL"))


def verify_notes(table, kind, sources, admin, files, year=S.YEAR):
    """Everything wrong with a unit's outputs, one row per note: gid_3, item, month (0: whole table), note.

    table: index table as it was read, its columns in contract order; files: one row per image file (kind, gid_3, month, state,
    error). A month needs exactly one file that is good, or none where evidence counts zero scenes. Units come from the admin table;
    rows of other units are not looked at.
    """
    schema_good = list(table.columns) == S.COLUMNS[kind]
    zeros, units = _zero_flags(sources), admin.select("gid_3").distinct()
    csv, image = F.lit(f"CSV/{kind}_indices.csv"), F.lit(f"Ảnh {kind}")
    label = F.concat(F.lit("tháng "), F.col("month").cast("string"), F.lit(": "))
    total = 12 * units.count()
    # read twice below, so written once; gid_3 alone places them, which serves every grouping that follows
    states = materialize(_key_states(_typed(table, kind), kind, zeros, year, total), "states")
    rows = placed(states, ["gid_3"], total).join(units, "gid_3", "left_semi")
    keys_of = rows.groupBy("gid_3", "year", "month").agg(F.count("*").alias("n"))
    in_year = F.coalesce(F.col("month").between(1, 12), F.lit(False))
    counted = keys_of.groupBy("gid_3").agg(
        F.sum("n").alias("rows"), F.count_distinct(F.when(in_year, F.col("month"))).alias("months"),
        F.count_if((F.col("n") > 1) | ~F.coalesce(F.col("year") == year, F.lit(False))).alias("bad"))
    counted = units.join(counted, "gid_3", "left").na.fill(0, ["rows", "months", "bad"])
    note = lambda df, item, month, text: df.select("gid_3", item.alias("item"), month.cast("long").alias("month"), text.alias("note"))
    parts = [note(counted.filter((F.col("rows") != 12) | (F.col("months") != 12)), csv, F.lit(0), F.lit(S.NOTE_MONTHS)),
             note(counted.filter("bad > 0"), csv, F.lit(0), F.lit(S.NOTE_KEY)),
             note(rows.filter(~F.col("state").isin(*S.TERMINAL)), csv, F.col("month"), F.concat(label, F.col("state"), F.lit(" "), F.coalesce("error", F.lit("")))).distinct()]
    if not schema_good:
        parts.append(note(units, csv, F.lit(0), F.lit(S.NOTE_SCHEMA)))
    found = files.filter(F.col("kind") == kind).groupBy("gid_3", "month").agg(
        F.count("*").alias("n"), F.max(F.struct((F.col("state") != "done").alias("bad"), "error")).alias("worst"))
    months = placed(month_grid(units, year), ["gid_3", "month"], total).join(found, ["gid_3", "month"], "left").join(zeros, ["gid_3", "month"], "left")
    n, excused = F.coalesce("n", F.lit(0)), F.coalesce(f"_zero_{kind}_image", F.lit(False))
    wrong = (F.when((n == 0) & excused, None).when(n != 1, F.concat(label, n.cast("string"), F.lit(" file")))
             .when(F.coalesce(F.col("worst")["bad"], F.lit(True)), F.concat(label, F.coalesce(F.col("worst")["error"], F.lit("")))))
    parts.append(note(months.withColumn("_w", wrong).filter("_w IS NOT NULL"), image, F.col("month"), F.col("_w")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def verify_report(notes, kind, admin):
    """Report rows per unit and item: gid_3, item, level (FAIL with any note, else PASS), note (the notes by month, joined)."""
    good = F.create_map(F.lit(f"CSV/{kind}_indices.csv"), F.lit(S.NOTE_CSV_GOOD), F.lit(f"Ảnh {kind}"), F.lit(S.NOTE_IMAGES_GOOD))
    units = admin.select("gid_3").distinct()
    items = placed(units.select("gid_3", F.explode(F.map_keys(good)).alias("item")), ["gid_3", "item"], 12 * units.count())
    said = notes.groupBy("gid_3", "item").agg(F.sort_array(F.collect_set(F.struct("month", "note"))).alias("said"))
    return items.join(said, ["gid_3", "item"], "left").select(
        "gid_3", "item", F.when(F.col("said").isNull(), "PASS").otherwise("FAIL").alias("level"),
        F.coalesce(F.array_join(F.transform("said", lambda x: x["note"]), "; "), good[F.col("item")]).alias("note"))


def worst(df, group, level="level"):
    """Worst level per group: FAIL over WARN over PASS."""
    order = F.when(F.col(level) == "FAIL", 2).when(F.col(level) == "WARN", 1).otherwise(0)
    return (df.groupBy(*group).agg(F.max(order).alias("_o"))
            .select(*group, F.element_at(F.array(*[F.lit(x) for x in ("PASS", "WARN", "FAIL")]),
                                         F.col("_o") + 1).alias("level")))


def group_state(units, tiles, tasks):
    """State of each (month, window) group: done, failed, waiting, partial or ready.

    units: prefix, gid_3, image_state, has_polygon, tiles_present; tiles: prefix, settled; tasks: prefix, state.
    """
    rolled = units.groupBy("prefix").agg(
        F.bool_and(F.col("image_state").isin(*S.TERMINAL)).alias("all_done"),
        F.bool_or(~F.col("image_state").isin(*S.TERMINAL) & ~F.col("has_polygon")).alias("no_polygon"),
        F.bool_or(~F.col("image_state").isin(*S.TERMINAL) & ~F.col("tiles_present")).alias("gaps"))
    have = tiles.groupBy("prefix").agg(F.bool_and("settled").alias("settled"))
    task = tasks.select("prefix", F.col("state").alias("task"))
    ready = F.when(F.col("task").isNotNull(), (F.col("task") == "COMPLETED") & F.col("settled").isNotNull()) \
        .otherwise(F.coalesce("settled", F.lit(False)))
    state = (F.when(F.col("all_done"), "done")
             .when(F.col("task").isin("FAILED", "CANCELLED", "CANCEL_REQUESTED"), "failed")
             .when(~ready, "waiting").when(F.col("no_polygon"), "failed").when(F.col("gaps"), "partial")
             .otherwise("ready"))
    return (rolled.join(have, "prefix", "left").join(task, "prefix", "left").select("prefix", state.alias("state")))
