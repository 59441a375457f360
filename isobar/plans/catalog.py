"""The catalog of products and models, forecast calendars, and formulas per cell."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators.sizes import maybe_broadcast
from isobar.plans.catalog_data import MODELS, PRODUCTS


def product_rows() -> list[dict]:
    out = []
    for line in PRODUCTS.strip().splitlines():
        code, units, kind, expr, knobs = line.split("|")
        out.append({"code": code, "units": units, "class": kind, "expr": expr or None} | {k: v for k, v in (x.split("=") for x in knobs.split())})
    return out


def model_rows() -> list[dict]:
    return [dict(zip(("model", "calendar", "bbox", "retain"), line.split("|"), strict=True)) for line in MODELS.strip().splitlines()]


def products(spark: SparkSession) -> DataFrame:
    """A row for each product."""
    number = lambda r, k: float(r[k]) if k in r else None
    rows = [(r["code"], r["units"], r["class"], r["expr"], r.get("resample", "bilinear"), number(r, "fh_min"), number(r, "fh_cap"), number(r, "fh_step"), number(r, "sentinel_lt")) for r in product_rows()]
    return spark.createDataFrame(rows, "code string, units string, class string, expr string, resample string, fh_min double, fh_cap double, fh_step double, sentinel_lt double")


def models(spark: SparkSession) -> DataFrame:
    """A row for each model, with its box."""
    rows = [(r["model"], r["calendar"], *map(float, r["bbox"].split(",")), int(r["retain"])) for r in model_rows()]
    return spark.createDataFrame(rows, "model string, calendar string, west double, south double, east double, north double, retain int")


def calendar(models: DataFrame) -> DataFrame:
    """``model, run_hour, fh, unit``: minutes before segments before synoptic runs before the plain range.

    A calendar is text: ``min a..b/s``, ``seg a..b/s + ...`` or ``a..b/s``,
    with ``; syn a..b/s at [hours]`` for runs at these hours.
    """
    span = lambda text, p: F.struct(*(F.regexp_extract(text, p, i).try_cast("int").alias(n) for i, n in enumerate("abs", 1)))
    main = F.trim(F.split_part("calendar", F.lit(";"), F.lit(1)))
    synoptic = F.split_part("calendar", F.lit(";"), F.lit(2))
    parts = F.split(F.regexp_replace(main, "^(seg|min) ", ""), r" \+ ")
    spans = F.transform(parts, lambda p: span(p, r"(\d+)\.\.(\d+)/(\d+)"))
    at = F.transform(F.split(F.regexp_extract(synoptic, r"\[(.*)\]", 1), ", "), lambda h: h.try_cast("int"))
    rows = models.select("model", F.when(main.startswith("min"), "minute").otherwise("hour").alias("unit"), spans.alias("spans"), span(synoptic, r"(\d+)\.\.(\d+)/(\d+)").alias("syn"), at.alias("at"))
    rows = rows.withColumn("run_hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    rows = rows.withColumn("spans", F.when(F.col("syn.a").isNotNull() & F.array_contains("at", F.col("run_hour")), F.array("syn")).otherwise(F.col("spans")))
    rows = rows.select("model", "run_hour", "unit", F.explode("spans").alias("x"))
    return rows.select("model", "run_hour", F.explode(F.sequence("x.a", "x.b", "x.s")).alias("fh"), "unit").distinct()


def candidate_runs(now: Column, back: int, step_hours: int = 1, latency_minutes: int = 0) -> Column:
    """Run times on the step, newest first, from ``now`` less the latency back."""
    last = F.floor((F.unix_timestamp(now) - 60 * latency_minutes) / (3600 * step_hours)) * (3600 * step_hours)
    return F.transform(F.sequence(F.lit(0), F.lit(back - 1)), lambda i: F.timestamp_seconds(last - i * (3600 * step_hours)))


def hourly_runs(now: Column, back: int, hours: tuple[int, ...] | None = None) -> Column:
    """The hours from ``now`` back, newest first, of which only some hours of the day may be allowed."""
    last = F.floor(F.unix_timestamp(now) / 3600) * 3600
    runs = F.transform(F.sequence(F.lit(0), F.lit(back)), lambda i: last - i * 3600)
    if hours is not None:
        runs = F.filter(runs, lambda t: F.array_contains(F.array(*map(F.lit, hours)), (t % 86400 / 3600).cast("int")))
    return F.transform(runs, F.timestamp_seconds)


def slots(now: Column, window_minutes: int, step_minutes: int, latency_minutes: int) -> Column:
    """Times on the step over a window that ends at ``now`` less the latency, newest last."""
    step = 60 * step_minutes
    last = F.floor((F.unix_timestamp(now) - 60 * latency_minutes) / step) * step
    return F.transform(F.sequence(F.lit(window_minutes // step_minutes), F.lit(0)), lambda i: F.timestamp_seconds(last - i * step))


def admitted(fh: Column, fh_min: Column, fh_cap: Column, fh_step: Column, skip: list[tuple[int, int]] = ()) -> Column:
    """Within floor and cap, on the step, and in no skipped range; nulls don't limit."""
    on = (fh >= F.coalesce(fh_min, F.lit(0))) & (fh <= F.coalesce(fh_cap, F.lit(1 << 30))) & (fh % F.coalesce(fh_step, F.lit(1)) == 0)
    for a, b in skip:
        on &= ~fh.between(a, b)
    return on


def _hours_before(pattern: Column) -> Column:
    """All N of ``{fh_minus_N}`` in a pattern."""
    return F.transform(F.regexp_extract_all(F.coalesce(pattern, F.lit("")), F.lit(r"\{fh_minus_(\d+)\}"), F.lit(1)), lambda n: n.cast("int"))


def implied_floor(*patterns: Column) -> Column:
    """Patterns that name the hour n before need n hours; the largest n of all of them."""
    return F.coalesce(F.array_max(F.concat(*map(_hours_before, patterns))), F.lit(0))


def filled_pattern(pattern: Column, fh: Column) -> Column:
    """``{fh}`` and every ``{fh_minus_N}`` replaced by hours."""
    before = lambda n: F.concat(F.lit("{fh_minus_"), n.cast("string"), F.lit("}"))
    filled = F.aggregate(F.array_distinct(_hours_before(pattern)), pattern, lambda p, n: F.replace(p, before(n), (fh - n).cast("string")))
    return F.replace(filled, F.lit("{fh}"), fh.cast("string"))


def admissions(listed: DataFrame, products: DataFrame, expected: DataFrame, mins: DataFrame, caps: DataFrame, skips: DataFrame) -> DataFrame:
    """P21 with C1: ``model, code, fh``: the hours that each product can be made for under each model.

    ``listed`` (model, code) are the models' products, ``products`` (code, fh_min,
    fh_cap, fh_step, patterns) the catalog, ``expected`` (model, fh) the models'
    hours.  A product's floor is the largest of its own, those that its patterns
    need and the model's (``mins``: model, code, fh); its caps are its own and the
    model's (``caps``, alike); hours that lie in a skipped range (``skips``:
    model, code, lo, hi) go.  Ranges may overlap.  All are as long as the catalog.
    """
    per = lambda t, f, name: t.groupBy("model", "code").agg(f("fh").alias(name))
    rows = listed.select("model", "code").distinct().join(maybe_broadcast(products), "code")
    rows = rows.join(per(mins, F.max, "least"), ["model", "code"], "left").join(per(caps, F.min, "most"), ["model", "code"], "left")
    need = F.aggregate(F.transform("patterns", lambda p: F.coalesce(F.array_max(_hours_before(p)), F.lit(0))), F.lit(0), lambda a, n: F.greatest(a, n))
    floor = F.greatest(F.coalesce("fh_min", F.lit(0)).cast("int"), need, F.coalesce("least", F.lit(0)).cast("int"))
    far = F.lit(1 << 30)
    rows = rows.select("model", "code", floor.alias("floor"), F.least(F.coalesce("fh_cap", far), F.coalesce("most", far)).alias("cap"), F.coalesce("fh_step", F.lit(1)).alias("every"))
    rows = rows.join(maybe_broadcast(expected.select("model", "fh").distinct()), "model").where("fh >= floor and fh <= cap and fh % every = 0")
    gone = skips.select(F.col("model").alias("m"), F.col("code").alias("k"), "lo", "hi")
    rows = rows.join(gone, (F.col("model") == F.col("m")) & (F.col("code") == F.col("k")) & F.col("fh").between(F.col("lo"), F.col("hi")), "left_anti")
    return rows.select("model", "code", "fh")


def object_key(template: Column, date: Column, run: Column, fh: Column) -> Column:
    """ST2: ``{date}``, ``{run:02d}``, ``{fh:03d}`` and ``{fhour}``, the file's hour of a minute."""
    for name, value in (("{date}", date), ("{run:02d}", F.lpad(run.cast("string"), 2, "0")), ("{fh:03d}", F.lpad(fh.cast("string"), 3, "0")), ("{fhour}", F.ceil(fh / 60).cast("string"))):
        template = F.replace(template, F.lit(name), value)
    return template


def formula(code: str) -> str:
    """A product's expression over the columns A, B, ..."""
    return {r["code"]: r["expr"] for r in product_rows()}[code]


def evaluated(inputs: DataFrame, codes: list[str], keys: list[str]) -> DataFrame:
    """A column for each product, of inputs that are columns A, B, ...; everything is one projection."""
    columns = {r["code"]: r for r in product_rows()}
    out = []
    for code in codes:
        r = columns[code]
        value = F.expr(r["expr"]).cast("double")
        if "sentinel_lt" in r or r["class"].startswith("mrms"):
            value = F.when(F.col("A") >= float(r.get("sentinel_lt", 0)), value)
        out.append(value.alias(code))
    return inputs.select(*keys, *out)


def inputs_of(cells: DataFrame, names: dict[int, str], keys: list[str]) -> DataFrame:
    """Fields as columns: ``cells`` (field, keys, v) pivoted by a fixed list of fields."""
    rows = cells.groupBy(*keys).pivot("field", list(names)).agg(F.max("v"))
    return rows.select(*keys, *(F.col(str(k)).alias(n) for k, n in names.items()))


def patterns_used(text: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", text)


def projected(products: DataFrame, models: DataFrame, overrides: DataFrame) -> DataFrame:
    """``model, code, match`` of every product (code, match) under every model (model).

    ``overrides`` (model, code, match) replace a product's match under one model;
    a null match there takes the product out of it.  All are rows of the catalog,
    so a model's list is as long as the catalog.
    """
    own = overrides.select("model", "code", F.col("match").alias("own"), F.lit(True).alias("replaced"))
    rows = models.select("model").crossJoin(F.broadcast(products.select("code", "match"))).join(maybe_broadcast(own), ["model", "code"], "left")
    return rows.select("model", "code", F.when(F.col("replaced"), F.col("own")).otherwise(F.col("match")).alias("match")).where("match is not null")


_LEADS = r"^\^:?([A-Za-z0-9]+):"  # a pattern that begins with a variable


def matched(inventory: DataFrame, projection: DataFrame) -> DataFrame:
    """Inventory messages (model, msg, text) with the product whose match they are, as a regular expression; of several the first by code.

    Most patterns begin with a variable, so messages meet those of their own
    variable, and the few others besides.
    """
    lead = F.regexp_extract("match", _LEADS, 1)
    patterns = maybe_broadcast(projection.withColumn("lead", lead))
    own = inventory.withColumn("lead", F.explode(F.array(F.regexp_extract("text", r"^:?([A-Za-z0-9]+):", 1), F.lit("")))).distinct()
    rows = own.join(patterns, ["model", "lead"]).where(F.expr("regexp_like(text, match)"))
    return rows.groupBy("model", "msg").agg(F.min("code").alias("code"))
