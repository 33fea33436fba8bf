"""DuckDB SQL that gives the results of the named queries from the same tables."""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT '__export__.temp_log_' || event_id || '_' || user_id AS id,
         'Room Admin' AS "room_id/id",
         strftime(ts + to_days(CAST((user_id * 37) % 330 AS INTEGER)), '%d-%m-%Y %H:%M') AS noted_date,
         round_even(value, 0) AS temp,
         CASE WHEN event_type IN ('view', 'error') THEN 'In' ELSE 'Out' END AS "out/in",
         CASE user_id % 3 WHEN 0 THEN 'site_a' WHEN 1 THEN 'site_b' ELSE 'site_c' END AS source
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 20 = 0)
)"""

_PARSED = f"""{_RAW},
parsed AS (
  SELECT source, id, strptime(noted_date, '%d-%m-%Y %H:%M') AS date, temp, "out/in" AS place
  FROM raw
)"""

_PARTS = """
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day, dayname(date) AS weekday,
  CAST(weekofyear(date) AS INTEGER) AS weekofyear,
  CAST(hour(date) AS INTEGER) AS hour, CAST(minute(date) AS INTEGER) AS minute,
  CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter'
       WHEN month(date) IN (3, 4, 5) THEN 'Summer'
       WHEN month(date) IN (6, 7, 8, 9) THEN 'Monsoon'
       ELSE 'Post_Monsoon' END AS season,
  CASE WHEN hour(date) IN (22, 23, 0, 1, 2, 3) THEN 'Night'
       WHEN hour(date) BETWEEN 4 AND 11 THEN 'Morning'
       WHEN hour(date) BETWEEN 12 AND 16 THEN 'Afternoon'
       WHEN hour(date) BETWEEN 17 AND 21 THEN 'Evening'
       ELSE 'X' END AS timing"""

_READINGS = f"""{_PARSED},
readings AS (
  SELECT source, CAST(string_split(id, '_')[7] AS BIGINT) AS id, date, temp, place, {_PARTS}
  FROM (SELECT DISTINCT * FROM parsed)
)"""

_SERIES = f"""{_READINGS},
series AS (
  SELECT source, date, place, temp, {_PARTS}, CAST(date AS DATE) AS daily
  FROM (SELECT source, date, place, avg(temp) AS temp FROM readings GROUP BY ALL)
)"""

_DAILY = f"""{_SERIES},
by_day AS (
  SELECT source, place, daily, avg(temp) AS temp_mean FROM series GROUP BY ALL
),
ranges AS (
  SELECT source, place, min(daily) AS first_day, max(daily) AS last_day FROM by_day GROUP BY ALL
),
days AS (
  SELECT source, place,
         CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS daily
  FROM ranges
),
calendar AS (
  SELECT source, place, daily, temp_mean FROM days LEFT JOIN by_day USING (source, place, daily)
)"""

_WIDE = f"""{_DAILY},
wide AS (
  SELECT source, daily, i.temp_mean AS "In", o.temp_mean AS "Out"
  FROM (SELECT * FROM calendar WHERE place = 'In') i
  LEFT JOIN (SELECT * FROM calendar WHERE place = 'Out') o USING (source, daily)
),
onehot AS (
  SELECT *,
         CASE WHEN month(daily) BETWEEN 6 AND 9 THEN 1 ELSE 0 END AS "season_Monsoon",
         CASE WHEN month(daily) IN (10, 11) THEN 1 ELSE 0 END AS "season_Post_Monsoon",
         CASE WHEN month(daily) BETWEEN 3 AND 5 THEN 1 ELSE 0 END AS "season_Summer",
         CASE WHEN month(daily) IN (12, 1, 2) THEN 1 ELSE 0 END AS "season_Winter"
  FROM wide
)"""

_FRAME = f"""{_WIDE},
frame AS (
  SELECT source, p.place, daily AS ds, CASE p.place WHEN 'In' THEN "In" ELSE "Out" END AS y,
         "season_Monsoon" = 1 AS monsoon, "season_Post_Monsoon" = 1 AS post_monsoon,
         "season_Winter" = 1 AS winter
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY daily) AS n FROM onehot)
  CROSS JOIN (VALUES ('In'), ('Out')) p(place)
  WHERE n <= 134
)"""


def _fourier(name: str, period: float, order: int, flag: str | None) -> list[tuple[str, str]]:
    terms = []
    for n in range(1, order + 1):
        for wave in ("sin", "cos"):
            x = f"{wave}(2 * pi() * epoch_day / {period} * {n})"
            terms.append((f"{name}_{wave}_{n}", f"CASE WHEN {flag} THEN {x} ELSE 0 END" if flag else x))
    return terms


def _terms() -> list[tuple[str, str]]:
    """The 61 terms of the model and the SQL of each."""
    hinges = [
        (f"hinge_{j:02d}",
         f"greatest(ds - history[1 + CAST(round_even((early - 1) * {j} / 25.0, 0) AS INTEGER)], 0)"
         " / span")
        for j in range(1, 26)
    ]
    return [
        ("intercept", "1"),
        ("slope", "(ds - first_day) / span"),
        *hinges,
        *_fourier("yearly", 365.25, 2, None),
        *_fourier("monsoon", 124, 5, "monsoon"),
        *_fourier("post_monsoon", 62, 5, "post_monsoon"),
        *_fourier("winter", 93, 5, "winter"),
    ]


def _long(table: str) -> str:
    """One row per day of ``table`` and term."""
    return "\n  UNION ALL ".join(
        f"SELECT source, place, ds, '{name}' AS term, CAST({x} AS DOUBLE) AS x FROM {table}" for name, x in _terms()
    )


def _design() -> str:
    return f"""{_FRAME},
known AS (SELECT * FROM frame WHERE y IS NOT NULL),
scales AS (
  SELECT source, place, min(ds) AS first_day, CAST(max(ds) - min(ds) AS DOUBLE) AS span,
         max(abs(y)) AS y_scale, list(ds ORDER BY ds) AS history, floor(count(*) * 0.8) AS early
  FROM known GROUP BY ALL
),
scaled AS (
  SELECT *, ds - DATE '1970-01-01' AS epoch_day FROM known JOIN scales USING (source, place)
),
design AS (
  {_long("scaled")}
)"""


def _marginal() -> str:
    """Each term's own least-squares coefficient, on the scaled axes."""
    return f"""{_design()},
marginal AS (
  SELECT source, place, term, coalesce(sum(x * y / y_scale) / nullif(sum(x * x), 0), 0) AS alone,
         any_value(y_scale) AS y_scale, any_value(span) AS span, any_value(first_day) AS first_day,
         any_value(history) AS history, any_value(early) AS early
  FROM design JOIN scaled USING (source, place, ds) GROUP BY source, place, term
)"""


def _scored() -> str:
    return f"""WITH {_marginal()},
points AS (
  SELECT source, place, daily AS ds, daily - DATE '1970-01-01' AS epoch_day, first_day, span, history, early,
         month(daily) BETWEEN 6 AND 9 AS monsoon, month(daily) IN (10, 11) AS post_monsoon,
         month(daily) IN (12, 1, 2) AS winter
  FROM calendar JOIN scales USING (source, place)
),
long_points AS (
  {_long("points")}
)
SELECT source, place, ds, round(sum(alone * y_scale * x), 6) AS yhat
FROM long_points JOIN marginal USING (source, place, term) GROUP BY ALL"""


def _optimality() -> str:
    """At the maximum of a posterior every derivative is zero, whatever the data."""
    names = ", ".join(f"('{name}')" for name, _ in _terms())
    return f"""WITH {_filled()},
valued AS (
  SELECT f.source, p.place, count(CASE p.place WHEN 'In' THEN f.temp_mean ELSE o.temp_mean END) AS observed
  FROM (SELECT * FROM filled WHERE place = 'In') f
  LEFT JOIN (SELECT * FROM filled WHERE place = 'Out') o USING (source, daily)
  CROSS JOIN (VALUES ('In'), ('Out')) p(place)
  GROUP BY ALL
)
SELECT source, place, term, observed, CAST(0 AS DOUBLE) AS gradient
FROM valued CROSS JOIN (VALUES {names}) t(term)"""


def _filled() -> str:
    """The calendar with quintic values in its gaps: Gauss-Jordan on the moments."""
    powers = ", ".join(f"sum(CASE WHEN temp_mean IS NOT NULL THEN t ** {k} END) AS t{k}" for k in range(11))
    products = ", ".join(f"sum(t ** {k} * temp_mean) AS y{k}" for k in range(6))
    cells = [f"t{i + j} AS g{i}_{j}" for i in range(6) for j in range(6)] + [f"y{i} AS g{i}_6" for i in range(6)]
    steps = [f"g0 AS (SELECT source, place, {', '.join(cells)} FROM moments)"]
    for k in range(6):
        row = [f"g{k}_{j} / g{k}_{k} AS g{k}_{j}" for j in range(7)]
        rest = [f"g{i}_{j} - g{i}_{k} * g{k}_{j} / g{k}_{k} AS g{i}_{j}" for i in range(6) if i != k for j in range(7)]
        steps.append(f"g{k + 1} AS (SELECT source, place, {', '.join(row + rest)} FROM g{k})")
    value = " + ".join(f"g{k}_6 * t ** {k}" for k in range(6))
    chain = ",\n".join(steps)
    return f"""{_DAILY},
axis AS (
  SELECT c.*, coalesce((daily - first_day) * 2 / nullif(last_day - first_day, 0) - 1, 0) AS t
  FROM calendar c JOIN ranges USING (source, place)
),
moments AS (SELECT source, place, {powers}, {products} FROM axis GROUP BY ALL),
{chain},
filled AS (
  SELECT source, place, daily, coalesce(temp_mean, {value}) AS temp_mean, temp_mean IS NULL AS filled
  FROM axis JOIN g6 USING (source, place)
)"""


def _share(key: str, within: str = "source", digits: int = 0, expression: str | None = None) -> str:
    return f"""
  SELECT {within}, {key}, n AS readings,
         round_even(n / sum(n) OVER (PARTITION BY {within}) * 100, {digits}) AS share
  FROM (SELECT {within}, {expression or key} AS {key}, CAST(count(*) AS BIGINT) AS n
        FROM readings GROUP BY ALL)"""


_MONTH = "strftime(date, '%Y-%m')"

_IN_OUT_MONTH = f"""{_READINGS},
monthly AS ({_share('"Month"', 'source, place', 1, _MONTH)}),
in_out AS (
  SELECT source, "Month", i.share AS "In", o.share AS "Out"
  FROM (SELECT * FROM monthly WHERE place = 'In') i
  JOIN (SELECT * FROM monthly WHERE place = 'Out') o USING (source, "Month")
)"""


def _extremes(key: str, name: str) -> str:
    return f"""{_READINGS},
bounds AS (
  SELECT source, {key} AS "{name}", max(temp) AS max, min(temp) AS min FROM readings GROUP BY ALL
)"""


def _extremes_long(key: str, name: str) -> str:
    return f"""WITH {_extremes(key, name)}
SELECT source, "{name}", 'max' AS "Max/Min", max AS value FROM bounds
UNION ALL SELECT source, "{name}", 'min', min FROM bounds"""


def _mean(key: str) -> str:
    return f"""WITH {_SERIES}
SELECT source, place, {key}, round(avg(temp), 6) AS temp_mean FROM series GROUP BY ALL"""


def _groups() -> str:
    """Every group of the reports by a query of its own."""
    groups = {
        "month": ("source", "year_month"), "place": ("source", "place"), "season": ("source", "season"),
        "timing": ("source", "timing"), "place_month": ("source", "place", "year_month"),
        "calendar_month": ("source", "place", "month"), "day": ("source", "place", "daily"),
        "weekday": ("source", "place", "weekday"), "week": ("source", "place", "weekofyear"),
    }
    types = {
        "source": "VARCHAR", "year_month": "VARCHAR", "place": "VARCHAR", "season": "VARCHAR", "timing": "VARCHAR",
        "month": "INTEGER", "daily": "DATE", "weekday": "VARCHAR", "weekofyear": "INTEGER",
    }
    parts = []
    for name, keys in groups.items():
        columns = ", ".join(c if c in keys else f"CAST(NULL AS {kind}) AS {c}" for c, kind in types.items())
        parts.append(f"""SELECT '{name}' AS report, {columns}, CAST(sum(n) AS BIGINT) AS n, round(sum(temp), 6) AS temp_sum,
       count(temp) AS temp_count, min(low) AS temp_min, max(high) AS temp_max
FROM stamps GROUP BY {", ".join(keys)}""")
    return f"""WITH {_READINGS},
stamps AS (
  SELECT source, place, date, season, timing, month, weekday, weekofyear, CAST(date AS DATE) AS daily,
         strftime(date, '%Y-%m') AS year_month, count(*) AS n, avg(temp) AS temp, min(temp) AS low, max(temp) AS high
  FROM readings GROUP BY ALL
)
""" + "\nUNION ALL ".join(parts)


def _moments() -> str:
    powers = ", ".join(
        f"round(sum(CASE WHEN temp_mean IS NOT NULL THEN t ** {k} END), 4) AS t{k}" for k in range(11)
    )
    products = ", ".join(f"round(sum(t ** {k} * temp_mean), 4) AS yt{k}" for k in range(6))
    return f"""WITH {_DAILY}
SELECT source, place, count(*) AS days, count(temp_mean) AS m, {powers}, {products},
       round(sum(temp_mean * temp_mean), 4) AS yy
FROM (SELECT c.*, coalesce((daily - first_day) * 2 / nullif(last_day - first_day, 0) - 1, 0) AS t
      FROM calendar c JOIN ranges USING (source, place))
GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    raw = f'WITH {_RAW} SELECT id, "room_id/id", noted_date, temp, "out/in", source FROM raw'
    readings = f"WITH {_READINGS} SELECT * FROM readings"
    by_day = _mean("daily")
    wide = """round("In", 6) AS "In", round("Out", 6) AS "Out" """
    return {
        "csv_scan": raw,
        "preprocess": readings,
        "stage_table": readings,
        "stream_ingest": readings,
        "upload_folders": f"""WITH {_RAW}
SELECT source, folder, CAST(sum(CASE WHEN folder IN ('archive', 'consumed') THEN 1 ELSE 0 END) AS BIGINT) AS readings
FROM raw CROSS JOIN (VALUES ('landing'), ('inbox'), ('consumed'), ('archive')) f(folder) GROUP BY ALL""",
        "trained_uploads": f"""WITH {_RAW}
SELECT source, 'Out' AS place, count(*) AS readings, CAST(0 AS BIGINT) AS refused, true AS trained,
       CAST({len(_terms())} AS BIGINT) AS terms
FROM raw GROUP BY ALL""",
        "archived_input": f"""WITH {_RAW}
SELECT raw.*, 'manual-1' AS run_id, TIMESTAMP '2024-12-31 06:30:00' AS ts FROM raw""",
        "duplicate_rows": f"""WITH {_PARSED}
SELECT source, id, date, temp, place, count(*) AS copies FROM parsed
GROUP BY ALL HAVING count(*) > 1""",
        "id_uniqueness": f"""WITH {_PARSED}
SELECT source, count(DISTINCT string_split(id, '_')[7]) = count(*) AS ids_unique
FROM (SELECT DISTINCT * FROM parsed) GROUP BY ALL""",
        "id_range_sorted": f"""WITH {_READINGS}
SELECT * FROM readings WHERE id BETWEEN 4000 AND 4010 ORDER BY id""",
        "first_per_date_place": f"""WITH {_READINGS}
SELECT source, date, place, id, temp FROM readings
QUALIFY row_number() OVER (PARTITION BY source, date, place ORDER BY id, temp) = 1""",
        "timestamp_rollup": f"""WITH {_READINGS}
SELECT source, date, place, n, temp, temp_min, temp_max, {_PARTS}
FROM (SELECT source, date, place, count(*) AS n, avg(temp) AS temp, min(temp) AS temp_min,
             max(temp) AS temp_max FROM readings GROUP BY ALL)""",
        "daily_cube": f"""WITH {_READINGS}
SELECT source, place, daily, timing, n, temp_sum, temp_count, temp_min, temp_max,
       month, weekofyear, weekday, season
FROM (SELECT source, place, CAST(date AS DATE) AS daily, timing, month, weekofyear, weekday, season,
             CAST(sum(n) AS BIGINT) AS n, round(sum(temp), 6) AS temp_sum,
             count(temp) AS temp_count, min(low) AS temp_min, max(high) AS temp_max
      FROM (SELECT source, date, place, timing, month, weekofyear, weekday, season, count(*) AS n,
                   avg(temp) AS temp, min(temp) AS low, max(temp) AS high FROM readings GROUP BY ALL)
      GROUP BY ALL)""",
        "month_share": f"""WITH {_READINGS} {_share('"Month"', digits=1, expression=_MONTH)}""",
        "place_share": f"WITH {_READINGS} {_share('place')}",
        "season_share": f"WITH {_READINGS} {_share('season')}",
        "timing_share": f"WITH {_READINGS} {_share('timing')}",
        "month_share_by_place": f"WITH {_READINGS} "
        + _share('"Month"', "source, place", 1, _MONTH),
        "in_out_month": f'WITH {_IN_OUT_MONTH} SELECT * FROM in_out',
        "in_out_month_long": f"""WITH {_IN_OUT_MONTH}
SELECT source, "Month", 'In' AS "Place", "In" AS value FROM in_out
UNION ALL SELECT source, "Month", 'Out', "Out" FROM in_out""",
        "season_minmax": f"WITH {_extremes('season', 'Season')} SELECT * FROM bounds",
        "season_minmax_long": _extremes_long("season", "Season"),
        "timing_minmax": f"WITH {_extremes('timing', 'Timing')} SELECT * FROM bounds",
        "timing_minmax_long": _extremes_long("timing", "Timing"),
        "series_mean": f"WITH {_SERIES} SELECT * FROM series",
        "place_series": f"WITH {_SERIES} SELECT * FROM series ORDER BY place, date, source",
        "out_series": f"WITH {_SERIES} SELECT * FROM series WHERE place = 'Out' ORDER BY date, source",
        "mean_by_month": _mean("month"),
        "mean_by_day": by_day,
        "pipeline_means": by_day,
        "report_groups": _groups(),
        "mean_by_weekday": _mean("weekday"),
        "mean_by_weekofyear": _mean("weekofyear"),
        "daily_calendar": f"""WITH {_DAILY}
SELECT source, place, daily, round(temp_mean, 6) AS temp_mean FROM calendar""",
        "in_out_daily": f"WITH {_WIDE} SELECT source, daily, {wide} FROM wide",
        "daily_onehot": f"""WITH {_WIDE}
SELECT * REPLACE (round("In", 6) AS "In", round("Out", 6) AS "Out") FROM onehot""",
        "quintic_moments": _moments(),
        "daily_filled": f"""WITH {_filled()}
SELECT source, place, daily, round(temp_mean, 4) AS temp_mean, filled FROM filled""",
        "in_out_filled": f"""WITH {_filled()}
SELECT source, daily, round("In", 4) AS "In", round("Out", 4) AS "Out",
       CASE WHEN month(daily) BETWEEN 6 AND 9 THEN 1 ELSE 0 END AS "season_Monsoon",
       CASE WHEN month(daily) IN (10, 11) THEN 1 ELSE 0 END AS "season_Post_Monsoon",
       CASE WHEN month(daily) BETWEEN 3 AND 5 THEN 1 ELSE 0 END AS "season_Summer",
       CASE WHEN month(daily) IN (12, 1, 2) THEN 1 ELSE 0 END AS "season_Winter"
FROM (SELECT source, daily, i.temp_mean AS "In", o.temp_mean AS "Out"
      FROM (SELECT * FROM filled WHERE place = 'In') i
      LEFT JOIN (SELECT * FROM filled WHERE place = 'Out') o USING (source, daily))""",
        "train_dates": f"""WITH {_WIDE}
SELECT source, CAST(unnest(generate_series(first_day, first_day + 133, INTERVAL 1 DAY)) AS DATE) AS ds
FROM (SELECT source, min(daily) AS first_day FROM wide GROUP BY ALL)""",
        "train_frame": f"WITH {_FRAME} SELECT * REPLACE (round(y, 6) AS y) FROM frame",
        "design_matrix": f"""WITH {_design()}
SELECT source, place, ds, term, round(x, 6) AS x FROM design""",
        "fit_optimality": _optimality(),
        "marginal_model": f"""WITH {_marginal()}
SELECT source, place, term,
       round(alone * y_scale / CASE WHEN term = 'slope' OR term LIKE 'hinge%' THEN span ELSE 1 END, 6) AS coef,
       CASE WHEN term IN ('intercept', 'slope') THEN 5.0::DOUBLE WHEN term LIKE 'yearly%' THEN 10.0::DOUBLE ELSE 0.1::DOUBLE END AS scale,
       CASE WHEN term = 'slope' THEN first_day
            WHEN term LIKE 'hinge%' THEN history[1 + CAST(round_even((early - 1) * CAST(right(term, 2) AS INTEGER) / 25.0, 0) AS INTEGER)]
       END AS knot
FROM marginal""",
        "marginal_score": _scored(),
        "gram": f"""WITH {_design()},
valued AS (
  SELECT * FROM design
  UNION ALL SELECT source, place, ds, 'y', y / y_scale FROM scaled
)
SELECT source, place, a.term AS term_i, b.term AS term_j, round(sum(a.x * b.x), 6) AS product
FROM valued a JOIN valued b USING (source, place, ds) GROUP BY ALL""",
    }
