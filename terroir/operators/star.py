"""Star-schema builders (D01-D15) and mart projections.

The reviews star is built from a raw review feed that carries an input order
(``ordinal``): dimension ids follow first appearance, fact ids follow the
feed position and keep their gaps after FK resolution drops rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions import char_len, lenient_int, lenient_price, strip, truncate
from terroir.operators.ids import global_row_number, rank_by_first

# Sentinels of the reference data model.
UNKNOWN = "Desconocido"
ANONYMOUS = "Anónimo"

REVIEW_COLUMNS = ["country", "description", "designation", "points", "price", "province", "region_1",
                  "region_2", "taster_name", "taster_twitter_handle", "title", "variety", "winery"]
TEXT_COLUMNS = ["country", "variety", "winery", "province", "region_1", "region_2", "designation", "title",
                "taster_name", "taster_twitter_handle", "description"]
# (dimension, source column, id column)
DIM_SPECS = [("dim_pais", "country", "id_pais"), ("dim_variedad", "variety", "id_variedad"),
             ("dim_bodega", "winery", "id_bodega"), ("dim_provincia", "province", "id_provincia"),
             ("dim_region", "region_1", "id_region")]


def with_ordinal(raw: DataFrame, order_cols: list[str], name: str = "ordinal") -> DataFrame:
    """Number the feed 1..n by its input order (scalable two-pass ids)."""
    return global_row_number(raw, order_cols, name)


# ---------------------------------------------------------------- D06
def clean_reviews(df: DataFrame) -> DataFrame:
    """Lenient numerics (F10) and text NULL→'' stripped.

    Text inputs go through the lenient parsers; already typed numeric
    inputs only need the NULL defaults and the int / cents casts (same
    result, no round trip through strings)."""
    types = dict(df.dtypes)
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float")
    pts = types.get("points", "string")
    prc = types.get("price", "string")
    points = (F.coalesce(F.col("points").cast("int"), F.lit(0))
              if pts in numeric and pts not in ("double", "float") else lenient_int("points"))
    price = (F.coalesce(F.col("price"), F.lit(0)).cast("decimal(10,2)")
             if prc.startswith("decimal") else lenient_price("price"))
    return df.withColumns({
        "points": points, "price": price,
        **{c: strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in TEXT_COLUMNS},
    })


# ---------------------------------------------------------------- D07
def build_dim(clean: DataFrame, src_col: str, id_col: str, ordinal: str = "ordinal") -> DataFrame:
    """Name dimension: blank → 'Desconocido', ids 1..n in first-appearance order."""
    name = F.when(F.col(src_col) == "", F.lit(UNKNOWN)).otherwise(F.col(src_col))
    return (rank_by_first(clean.select(name.alias("nombre"), ordinal), "nombre", ordinal, id_col)
            .select(F.col(id_col).cast("int").alias(id_col), "nombre"))


# ---------------------------------------------------------------- D08
def build_taster_dim(clean: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Taster dim: '' → 'Anónimo' in name and handle, first handle per name."""
    def anon(c):
        return F.when(F.col(c) == "", F.lit(ANONYMOUS)).otherwise(F.col(c))
    firsts = (clean.select(anon("taster_name").alias("nombre"), anon("taster_twitter_handle").alias("twitter"),
                           ordinal)
              .groupBy("nombre")
              .agg(F.min(F.struct(ordinal, "twitter")).alias("_f")))
    firsts = firsts.select("nombre", F.col("_f.twitter").alias("twitter"), F.col(f"_f.{ordinal}").alias("_first"))
    return (global_row_number(firsts, ["_first", "nombre"], "id_catador")
            .select(F.col("id_catador").cast("int").alias("id_catador"), "nombre", "twitter"))


# ---------------------------------------------------------------- D09
def build_fact(clean: DataFrame, dims: dict[str, DataFrame], ordinal: str = "ordinal") -> DataFrame:
    """Fact with FK resolution; rows with an unresolved key drop out.

    The lookup uses the cleaned value, so a blank name ('' — the dimension
    holds 'Desconocido') finds no member and the review is dropped, while a
    blank taster resolves to 'Anónimo'.  Dimension joins are left to AQE:
    bounded dims become broadcast joins at runtime, large ones stay shuffled.
    """
    fact = clean.select(
        F.col(ordinal).cast("long").alias("id_resena"), "points", "price", "title", "designation",
        "description", "region_2",
        *[s for _, s, _ in DIM_SPECS],
        F.when(F.col("taster_name") == "", F.lit(ANONYMOUS)).otherwise(F.col("taster_name")).alias("_taster"))
    for dim_name, src, id_col in DIM_SPECS:
        d = dims[dim_name].select(id_col, F.col("nombre").alias(src))
        fact = fact.join(d, src, "inner")
    t = dims["dim_catador"].select("id_catador", F.col("nombre").alias("_taster"))
    fact = fact.join(t, "_taster", "inner")
    return fact.select("id_resena", "points", "price", "title", "designation", "description", "region_2",
                       "id_pais", "id_variedad", "id_bodega", "id_provincia", "id_region", "id_catador")


def build_all_dims(clean: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """D07 + D08 in one pass: the five name dimensions and the taster
    dimension stacked as (dim, id, nombre, twitter), numbered together.

    One scan of the feed, one aggregation, one two-pass numbering — instead
    of six.  ``dim_table(all_dims, name)`` splits them back.
    """
    def blank(c, repl):
        return F.when(F.col(c) == "", F.lit(repl)).otherwise(F.col(c))
    entries = [F.struct(F.lit(d).alias("dim"), blank(src, UNKNOWN).alias("nombre")) for d, src, _ in DIM_SPECS]
    entries.append(F.struct(F.lit("dim_catador").alias("dim"), blank("taster_name", ANONYMOUS).alias("nombre")))
    stacked = clean.select(ordinal, F.explode(F.array(*entries)).alias("e")).select(ordinal, "e.*")
    # the smallest ordinal is a plain long: a hash aggregate, combined before the shuffle
    firsts = stacked.groupBy("dim", "nombre").agg(F.min(ordinal).alias("_first"))
    from terroir.operators.ids import rank_within_groups
    ranked = rank_within_groups(firsts, "dim", ["_first", "nombre"], "id")
    # only tasters carry a handle: that of the row where the taster came first
    tasters = ranked.filter(F.col("dim") == "dim_catador").select(F.col("_first").alias("_f"))
    handles = (clean.select(F.col(ordinal).alias("_f"), blank("taster_twitter_handle", ANONYMOUS).alias("twitter"))
               .join(tasters, "_f", "left_semi").withColumn("dim", F.lit("dim_catador")))
    return (ranked.withColumn("_f", F.col("_first")).join(handles, ["dim", "_f"], "left")
            .select("dim", "id", "nombre", "twitter"))


DIM_IDS = {**{d: i for d, _, i in DIM_SPECS}, "dim_catador": "id_catador"}


def dim_table(all_dims: DataFrame, name: str) -> DataFrame:
    cols = [F.col("id").cast("int").alias(DIM_IDS[name]), "nombre"]
    if name == "dim_catador":
        cols.append("twitter")
    return all_dims.filter(F.col("dim") == name).select(*cols)


def review_star(raw: DataFrame, order_cols: list[str] | None = None) -> dict[str, DataFrame]:
    """Clean → 5 name dims + taster dim → fact."""
    feed = raw if order_cols is None else with_ordinal(raw, order_cols)
    clean = clean_reviews(feed)
    dims = {name: build_dim(clean, src, id_col) for name, src, id_col in DIM_SPECS}
    dims["dim_catador"] = build_taster_dim(clean)
    return {**dims, "fact_resenas": build_fact(clean, dims), "clean": clean}


# ---------------------------------------------------------------- D01-D05
def stg_review(fact: DataFrame) -> DataFrame:
    """D01 staging: canonical names, one row per id (W01 keeps the smallest row)."""
    from terroir.operators.windows import dedup_by_id
    renamed = fact.select(
        "id_resena", F.col("points").alias("puntos"), F.col("price").alias("precio"),
        F.col("title").alias("titulo"), F.col("designation").alias("designacion"),
        F.col("description").alias("descripcion"), "region_2", "id_pais", "id_variedad", "id_bodega",
        "id_provincia", "id_region", "id_catador")
    return dedup_by_id(renamed, "id_resena")


def fct_review(stg: DataFrame) -> DataFrame:
    """FK renames + description length."""
    return stg.select(
        "id_resena", F.col("id_variedad").alias("id_vino"), "id_bodega", "id_region", "id_catador",
        F.col("id_pais").alias("id_mercado"), "puntos", "precio",
        char_len("descripcion").alias("longitud_descripcion"))


def fct_score(fct: DataFrame, lo: int = 80, hi: int = 100) -> DataFrame:
    """Scores within [lo, hi]."""
    return (fct.filter(F.col("puntos").between(lo, hi))
            .select("id_resena", "id_vino", "id_catador", "id_mercado", F.col("puntos").alias("puntuacion")))


def fct_price(fct: DataFrame) -> DataFrame:
    """Positive prices with a constant currency."""
    return (fct.filter(F.col("precio") > 0)
            .select("id_resena", "id_vino", "id_bodega", "id_mercado", "precio", F.lit("USD").alias("moneda")))


def rename_dim(dim: DataFrame, id_col: str, new_id: str, new_name: str) -> DataFrame:
    """Rename a name dimension for the marts."""
    return dim.select(F.col(id_col).alias(new_id), F.col("nombre").alias(new_name))


def mart_dims(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_vino": rename_dim(dims["dim_variedad"], "id_variedad", "id_vino", "variedad"),
        "dim_bodega_vino": rename_dim(dims["dim_bodega"], "id_bodega", "id_bodega", "bodega"),
        "dim_region_vitivinicola": rename_dim(dims["dim_region"], "id_region", "id_region", "region"),
        "dim_catador_sumiller": dims["dim_catador"].select(
            "id_catador", F.col("nombre").alias("catador"), F.col("twitter").alias("twitter")),
        "dim_mercado_vino": rename_dim(dims["dim_pais"], "id_pais", "id_mercado", "pais"),
    }


def known_members(df: DataFrame, col: str) -> DataFrame:
    """Exclude the unknown member."""
    return df.filter(F.col(col) != UNKNOWN)


# ---------------------------------------------------------------- D14
# Spanish month names, January first.
MONTH_NAMES_ES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
                  "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]


def month_dim(periods: DataFrame, col: str = "id_tiempo") -> DataFrame:
    """Month dimension from a frame of YYYYMM ids."""
    p = F.col(col).cast("int")
    y, m = F.floor(p / 100).cast("int"), (p % 100).cast("int")
    names = F.array(*[F.lit(n) for n in MONTH_NAMES_ES])
    return periods.select(
        p.alias("id_tiempo"), F.make_date(y, m, F.lit(1)).alias("fecha"), y.alias("anio"),
        (F.floor((m - 1) / 3) + 1).cast("int").alias("trimestre"), m.alias("mes"),
        F.element_at(names, m).alias("mes_nombre"),
        F.concat(y.cast("string"), F.lit("-"), F.lpad(m.cast("string"), 2, "0")).alias("periodo"))
