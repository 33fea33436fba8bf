"""Terms of the seasonal trend model and their cross products.

The model (Taylor and Letham 2018) is a linear trend whose slope may change on
25 days spread over the first 80 % of the history, plus Fourier terms: two yearly
ones, and five within each of three seasons, active on days of that season only.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import pi

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermoloom.functions.calendar import text_array
from thermoloom.schemas import SERIES

# Model settings.
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8


@dataclass(frozen=True)
class Season:
    """A Fourier block; ``flag`` names the season it is limited to."""

    name: str
    period: float
    order: int
    scale: float
    flag: str | None = None


# Seasonal blocks and prior scales.
SEASONS = (
    Season("yearly", 365.25, 2, 10.0),
    Season("monsoon", 124, 5, 0.1, "Monsoon"),
    Season("post_monsoon", 62, 5, 0.1, "Post_Monsoon"),
    Season("winter", 93, 5, 0.1, "Winter"),
)
TREND_SCALE = 5.0
CHANGEPOINT_SCALE = 0.1


@dataclass(frozen=True)
class Term:
    """One model term: its name and prior scale."""

    name: str
    scale: float
    laplace: bool = False


def trend_terms() -> list[Term]:
    changes = [
        Term(f"hinge_{j:02d}", CHANGEPOINT_SCALE, laplace=True) for j in range(1, CHANGEPOINTS + 1)
    ]
    return [Term("intercept", TREND_SCALE), Term("slope", TREND_SCALE), *changes]


def season_terms(season: Season) -> list[Term]:
    return [
        Term(f"{season.name}_{wave}_{n}", season.scale)
        for n in range(1, season.order + 1)
        for wave in ("sin", "cos")
    ]


#: All 61 terms, in the order of the arrays below.
TERMS = [*trend_terms(), *[term for season in SEASONS for term in season_terms(season)]]


def fourier(season: Season, day: str) -> str:
    """Sine and cosine of each order, on days counted from 1970-01-01."""
    turn = f"unix_date({day}) * {2 * pi / season.period!r}D * n"
    return f"flatten(transform(sequence(1, {season.order}), n -> array(sin({turn}), cos({turn}))))"


def limited_to(active: str, season: Season, waves: str) -> str:
    """The block on days of its season, zeros on others."""
    return f"IF({active}, {waves}, array_repeat(0D, {2 * season.order}))"


def hinges(day: str, knots: str) -> str:
    """Days past each changepoint; zero before it, and for an absent one."""
    return f"transform({knots}, knot -> CAST(greatest(datediff({day}, knot), 0) AS DOUBLE))"


def design(train: DataFrame) -> DataFrame:
    """Model terms of every training day that has a value.

    Per row: ``x``, the 61 terms on the scaled axes; ``z``, the value divided by
    ``y_scale``; and what maps the fit back (``start``, ``span`` in days and the
    changepoint days ``knots``). One window over a series, which holds the
    training days only, gives the scaling; later steps keep its partitioning.

    Changepoints are evenly spread positions in the early history. The array
    always has 25 elements; a short history fills it up with NULL.
    """
    series = Window.partitionBy(*SERIES)
    known = train.where("y IS NOT NULL")
    scaled = known.withColumns(
        {
            "start": F.min("ds").over(series),
            "end": F.max("ds").over(series),
            "largest": F.max(F.abs("y")).over(series),
            "observed": F.count(F.lit(1)).over(series),
            "position": F.row_number().over(series.orderBy("ds")) - 1,
        }
    ).selectExpr(
        "*",
        "datediff(end, start) AS span",
        "IF(largest = 0, 1D, largest) AS y_scale",
        f"floor(observed * {CHANGEPOINT_RANGE}D) - 1 AS last",
        f"least({CHANGEPOINTS}, floor(observed * {CHANGEPOINT_RANGE}D) - 1) AS changes",
    )
    # the days at the changepoints' positions: a series holds these few, not its history
    wanted = f"transform(sequence(1, {CHANGEPOINTS}), j -> CAST(bround(last * j / changes, 0) AS INT))"
    scaled = scaled.withColumn("wanted", F.expr(f"IF(changes > 0, {wanted}, array())")).withColumn(
        "few",
        F.collect_list(F.expr("IF(array_contains(wanted, position), struct(position, ds), NULL)")).over(series),
    )
    knots = f"""transform(sequence(1, {CHANGEPOINTS}), j ->
        IF(j <= changes, map_from_entries(few)[wanted[j - 1]], NULL))"""
    blocks = [
        "array(1D, datediff(ds, start) / span)",
        f"transform({hinges('ds', 'knots')}, past -> past / span)",
    ]
    for season in SEASONS:
        waves = fourier(season, "ds")
        blocks.append(limited_to(season.name, season, waves) if season.flag else waves)
    return scaled.withColumn("knots", F.expr(knots)).selectExpr(
        *SERIES,
        "ds",
        "start",
        "span",
        "y_scale",
        "knots",
        "observed",
        "y / y_scale AS z",
        f"concat({', '.join(blocks)}) AS x",
    )


def design_matrix(designed: DataFrame) -> DataFrame:
    """The design in long form, one row per day and term."""
    names = text_array([term.name for term in TERMS])
    return designed.selectExpr(*SERIES, "ds", "posexplode_outer(x) AS (position, x)").selectExpr(
        *SERIES, "ds", f"{names}[position] AS term", "x"
    )


def gram(designed: DataFrame) -> DataFrame:
    """Cross products of all terms and of the scaled value, summed over days.

    Row ``i`` of a series holds the sums of term ``i`` times every term; the last
    row and the last element belong to the scaled value. A day gives one row per
    term, not one per pair of terms, and the days are summed inside the
    partitioning that the design already has.
    """
    products = ", ".join(f"sum(vi * v[{j}])" for j in range(len(TERMS) + 1))
    return (
        designed.withColumn("v", F.expr("concat(x, array(z))"))
        .selectExpr("*", "posexplode_outer(v) AS (i, vi)")
        .withColumn("knot", F.expr("IF(i = 1, start, get(knots, i - 2))"))
        .groupBy(*SERIES, "i")
        .agg(
            *[F.max(name).alias(name) for name in ("knot", "span", "y_scale", "observed")],
            F.expr(f"array({products}) AS products"),
        )
    )


def gram_long(products: DataFrame) -> DataFrame:
    """The cross products in long form, one row per ordered pair of terms."""
    names = text_array([*[term.name for term in TERMS], "y"])
    return products.selectExpr(*SERIES, "i", "posexplode(products) AS (j, product)").selectExpr(
        *SERIES, f"{names}[i] AS term_i", f"{names}[j] AS term_j", "product"
    )
