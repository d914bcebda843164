"""Season-aware synchronisation of spreadsheets into the parcel table, as set operations.

Closings take effect before openings read the table. A new season's row inherits the
past season's columns, overwritten by what the sheet holds. Running it again changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import scalar as S
from verdance.functions import tables as K
from verdance.operators import temporal as T

KEY = ["id_parcela", "ingenio"]


@dataclass
class Synced:
    table: DataFrame
    log: DataFrame
    stats: DataFrame


def typed_sheet(sheet: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A sheet of text cells in the types of the parcel table; unknown columns go. __error marks infinite numbers; __order is the sheet's order."""
    sheet = sheet.toDF(*[c.strip().lower() for c in sheet.columns])
    known = [*K.NUMERIC_COLUMNS, *K.DATE_COLUMNS, *K.BOOLEAN_COLUMNS, *K.STRING_COLUMNS, *[f"division_{i:02d}" for i in range(1, 36)]]
    use = [c for c in sheet.columns if c in (columns or known)]
    numeric = [c for c in use if c in K.NUMERIC_COLUMNS or c.startswith("division_")]
    error = F.lit(False)
    for c in numeric:
        error |= S.is_infinite(F.col(c))
    order = F.col("__order") if "__order" in sheet.columns else F.monotonically_increasing_id()
    return sheet.select(*[S.coerce_column(c, F.col(c)).alias(c) for c in use], error.alias("__error"), F.col("ciclo").cast("string").alias("__ciclo") if "ciclo" in use else F.lit(None).cast("string").alias("__ciclo"), order.alias("__order"))


def _last(rows: DataFrame) -> DataFrame:
    """Of rows that repeat a key, the last of the sheet."""
    return T.top_by(rows, KEY, [F.desc("__order")])


def _filled(sheet: str, past: str, c: str, own: list[str], had: list[str]) -> Column:
    cols = [F.col(f"{sheet}.{c}")] * (c in own) + [F.col(f"{past}.{c}")] * (c in had)
    return F.coalesce(*cols) if cols else F.lit(None)


def sync(table: DataFrame, closing: DataFrame, opening: DataFrame, today: Column, mill: str | None = None, old_season: int = 2026, new_season: int = 2027) -> Synced:
    """The new table, a log of actions, and their counts.

    closing: rows of the old season's sheet; those with an end date up to today update
    their row and close it. opening: rows of the new season's sheet; those begun by
    today are checked against the past season's cycle, and update or insert.
    """
    columns, kinds = table.columns, dict(table.dtypes)
    shut, begun = (typed_sheet(s, [c for c in columns if c != "temporada_activa"]) for s in (closing, opening))
    if mill is not None:
        name = S.normalized_name(F.lit(mill))
        shut, begun = (s.where(S.normalized_name(F.col("ingenio")) == name) for s in (shut, begun))
    bad = shut.unionByName(begun, allowMissingColumns=True).where("__error").select(*KEY, F.lit("error").alias("action"), F.lit("infinite number").alias("detail"))
    shut = _last(shut.where(~F.col("__error") & F.col("fecha_fin").isNotNull() & (F.col("fecha_fin") <= today)))
    begun = _last(begun.where(~F.col("__error") & F.col("fecha_inicio").isNotNull() & (F.col("fecha_inicio") <= today)))
    fixed = [*KEY, "zafra", "temporada_activa"]

    t, s = table.alias("t"), shut.alias("s")
    match = (F.col("t.id_parcela") == F.col("s.id_parcela")) & (F.col("t.ingenio") == F.col("s.ingenio")) & (F.col("t.zafra").try_cast("int") == old_season)
    hit = F.col("s.id_parcela").isNotNull()
    own = [c for c in shut.columns if not c.startswith("__") and c not in fixed]
    closed = t.join(s, match, "left").select(*[
        F.when(hit, F.lit(False)).otherwise(F.col("t.temporada_activa")).alias(c) if c == "temporada_activa"
        else (F.when(hit, F.coalesce(F.col(f"s.{c}").cast(kinds[c]), F.col(f"t.{c}"))).otherwise(F.col(f"t.{c}")).alias(c) if c in own else F.col(f"t.{c}"))
        for c in columns])
    close_log = s.join(t, match, "left").select("s.id_parcela", "s.ingenio", F.when(F.col("t.id_parcela").isNotNull(), "closed").otherwise("skipped").alias("action"), F.lit(None).cast("string").alias("detail")).distinct()

    past = T.past_record(closed, new_season, KEY)
    b, p = begun.alias("b"), past.alias("p")
    keyed = (F.col("b.id_parcela") == F.col("p.id_parcela")) & (F.col("b.ingenio") == F.col("p.ingenio"))
    own = [c for c in begun.columns if not c.startswith("__")]
    check = S.cycle_check(F.col("p.ciclo").cast("string"), S.cleaned(F.col("b.__ciclo")))
    rows = b.join(p, keyed, "left").select(
        check.alias("__check"), *[
            F.col(f"b.{c}").cast(kinds[c]).alias(c) if c in KEY else F.lit(str(new_season)).cast(kinds[c]).alias(c) if c == "zafra" else F.lit(True).alias(c) if c == "temporada_activa"
            else _filled("b", "p", c, own, columns).cast(kinds[c]).alias(c) for c in columns])
    good, refused = rows.where(F.col("__check").startswith("ok")), rows.where(~F.col("__check").startswith("ok"))

    season = F.col("c.zafra").try_cast("int") == new_season
    c, g = closed.alias("c"), good.alias("g")
    same = (F.col("c.id_parcela") == F.col("g.id_parcela")) & (F.col("c.ingenio") == F.col("g.ingenio")) & season
    merged = c.join(g, same, "full").select(*[F.when(F.col("g.id_parcela").isNotNull(), F.coalesce(F.col(f"g.{k}"), F.col(f"c.{k}"))).otherwise(F.col(f"c.{k}")).alias(k) for k in columns])
    have = closed.where(F.col("zafra").try_cast("int") == new_season).select(*KEY).distinct().withColumn("__have", F.lit(True))
    open_log = good.join(have, KEY, "left").select(*KEY, F.when(F.col("__have"), "updated").otherwise("inserted").alias("action"), F.col("__check").alias("detail"))
    cycle_log = refused.select(*KEY, F.lit("ciclo_error").alias("action"), F.col("__check").alias("detail"))
    log = close_log.unionByName(open_log).unionByName(cycle_log).unionByName(bad)
    return Synced(merged, log, log.groupBy("action").agg(F.count("*").alias("n")))


def preview(closing: DataFrame, opening: DataFrame, today: Column) -> DataFrame:
    """How many rows would close and open, without checks of the table."""
    shut, begun = typed_sheet(closing), typed_sheet(opening)
    n = shut.where(F.col("fecha_fin") <= today).select(F.lit("close").alias("action")).unionByName(begun.where(F.col("fecha_inicio") <= today).select(F.lit("open").alias("action")))
    return n.groupBy("action").agg(F.count("*").alias("n"))


def merge(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge: the new value where there is one, else the old."""
    rest = [c for c in old.columns if c not in keys]
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    action = F.when(F.col(f"o.{keys[0]}").isNull(), "inserted").when(F.col(f"n.{keys[0]}").isNull(), "kept").otherwise("updated")
    return o.join(n, on, "full").select(*[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys], *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in rest], action.alias("action"))


def active_seasons(table: DataFrame, mill: str) -> DataFrame:
    """Distinct seasons of a mill's active rows, sorted."""
    return table.where((S.normalized_name(F.col("ingenio")) == S.normalized_name(F.lit(mill))) & F.col("temporada_activa")).select("zafra").distinct().orderBy("zafra")


def duplicate_ids(table: DataFrame, key: str = "id_parcela") -> DataFrame:
    """rows, ids and how many rows repeat an id."""
    return table.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("ids"), (F.count("*") - F.count_distinct(key)).alias("repeats"))
