"""Independent SQL (DuckDB dialect) for every registered query.

Written from the semantics of the original jobs, not from the Spark plans:
the household transform below keeps the original shape (group, join back,
max, join back).  The driver tables are views named after the parquet files.
Double outputs are rounded half-up to 4 decimals, like ``catalog.present``.
"""

from __future__ import annotations

SAMPLE_DAY = "2024-01-10"
NEXT_DAY = "2024-01-11"
DAY_AFTER = "2024-01-12"


def d(x: float) -> str:
    """Double literal."""
    return f"CAST('{x!r}' AS DOUBLE)"


def r4(expr: str) -> str:
    return f"floor(({expr}) * 10000.0 + 0.5) / 10000.0"


def exact_sum(expr: str) -> str:
    """Sum of doubles as decimals with 10 digits after the point, cast to double once
    (through text, which rounds correctly)."""
    return f"CAST(CAST(sum(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE)"


def exact_mean(expr: str) -> str:
    return f"({exact_sum(expr)} / nullif(count({expr}), 0))"


E = d(61440.0)

# -- mapping of the driver tables (same rules as sources.driver_tables) --------

RAW = f"""raw AS (
  SELECT event_id AS rid,
         CAST(user_id AS VARCHAR) AS capteur,
         date_trunc('hour', ts) AS date,
         CASE WHEN event_type = 'error' THEN {E} ELSE {d(1500.0)} + floor(value * {d(10.0)}) END AS temperature,
         CASE WHEN event_type = 'error' OR (event_type = 'view' AND value < {d(25.0)}) THEN {E}
              ELSE {d(200.0)} + floor(value) END AS hr,
         CASE WHEN event_type = 'error' THEN {E} ELSE floor(value * {d(2.0)}) END AS debit_position_1,
         CASE WHEN event_type = 'error' OR (event_type = 'click' AND value > {d(400.0)}) THEN {E}
              ELSE floor(value * {d(1.5)}) END AS debit_pression_1,
         CASE WHEN event_type = 'error' THEN {E} ELSE {d(300.0)} + floor(value) END AS co2,
         CASE WHEN event_type = 'error' THEN {E} ELSE floor(value * {d(2.0)}) END AS orientation,
         CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND value < {d(10.0)}) THEN {E}
              ELSE floor(value / {d(10.0)}) END AS vitesse_vent,
         CASE WHEN event_type = 'error' THEN {E} ELSE floor(value * {d(2.0)}) END AS puissance,
         CASE WHEN event_type = 'error' THEN {E} ELSE {d(61.0)} + floor(value * {d(1.5)}) END AS pression,
         CASE WHEN event_type = 'error' THEN {E} ELSE value END AS consommation
  FROM events)"""

LINES = """lines AS (
  SELECT event_id AS rid,
         CASE WHEN event_type = 'view' THEN 'Station météo '
              WHEN event_type = 'click' THEN 'caisson '
              WHEN event_type = 'purchase' THEN 'Salle 1 '
              WHEN event_type = 'signup' THEN 'Capteur '
              ELSE 'Salle de bain ' END
         || lpad(CAST(user_id AS VARCHAR), 3, '0') || ' le ' || strftime(ts, '%d %m %Y') || '.acq' AS file_name,
         CASE WHEN event_type = 'signup' AND value < 5.0 THEN 'bad' ELSE strftime(ts, '%d/%m/%Y %H:%M') END AS "Date"
  FROM events)"""

CAPTEUR = f"""capteur AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id_capteur,
         CAST(CAST(floor(c_custkey / 8) AS BIGINT) AS VARCHAR) AS logement,
         CASE WHEN c_acctbal < {d(1500.0)} THEN 'WC' ELSE 'Sejour' END AS piece,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'EA'
              WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'Bouche'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Station'
              ELSE 'Ambiance' END AS type,
         coalesce(c_acctbal >= {d(0.0)}, false) AS reel
  FROM customer)"""

FT = f"""ft AS (SELECT CAST(s_suppkey AS VARCHAR) AS capteur_facteur, s_acctbal / {d(1000.0)} AS fct1 FROM supplier)"""
FP1 = f"""fp1 AS (SELECT CAST(s_suppkey AS VARCHAR) AS capteur_facteur, s_acctbal / {d(10000.0)} AS fct1 FROM supplier)"""
FP2 = f"""fp2 AS (
  SELECT CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS VARCHAR) AS capteur_facteur,
         p_retailprice / {d(1000.0)} AS fct1,
         p_size / {d(100.0)} AS fct2,
         -p_size / {d(100000.0)} AS fct3,
         (p_partkey % 4) / {d(1000000.0)} AS fct4,
         (p_partkey % 4) * {d(250.0)} AS borne_inf,
         (p_partkey % 4) * {d(250.0)} + {d(200.0)} + p_size * {d(2.0)} AS borne_sup,
         CASE WHEN p_size % 7 = 0 THEN NULL
              WHEN p_size % 5 = 0 THEN p_retailprice / {d(100.0)}
              ELSE {d(0.0)} END AS valeur_defaut
  FROM part)"""
FQ2 = f"""fq2 AS (
  SELECT CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS VARCHAR) AS capteur_facteur,
         p_size / {d(10.0)} AS fct1,
         p_retailprice / {d(10000.0)} AS fct2,
         -p_size / {d(1000000.0)} AS fct3,
         (p_partkey % 3) * {d(350.0)} AS borne_inf,
         (p_partkey % 3) * {d(350.0)} + {d(300.0)} + p_size * {d(2.0)} AS borne_sup
  FROM part)"""
FS = f"""fs AS (
  SELECT CAST(CAST(floor(c_custkey / 8) AS BIGINT) AS VARCHAR) AS logement_facteur,
         c_nationkey * {d(0.25)} + {d(0.5)} AS fct1
  FROM customer WHERE c_custkey % 8 = 0 AND c_nationkey <> 3)"""

DIMS = [CAPTEUR, FT, FP1, FP2, FQ2, FS]
LOG = ("temperature", "hr", "debit_position_1", "debit_pression_1", "co2")
STATION = ("temperature", "hr", "orientation", "vitesse_vent", "co2")
CAISSON = ("puissance", "pression", "consommation")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def fill(name: str, source: str, measures, partition: str, order: str = "date, rid") -> str:
    """Forward fill over good values (error code and nulls skipped)."""
    cols = ",\n         ".join(
        f"last_value(nullif({m}, {E}) IGNORE NULLS) OVER w AS {m}" for m in measures
    )
    return f"""{name} AS (
  SELECT rid, capteur, date,
         {cols}
  FROM {source}
  WINDOW w AS (PARTITION BY {partition} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


BRUT = fill("brut", "raw", LOG, "capteur")
BRUT_DAY = fill("brut_day", "raw", LOG, "capteur, CAST(date AS DATE)")


def ghosts(readings: str = "raw") -> str:
    """Virtual-sensor rows over [first day, last day + 1) of ``readings``."""
    zeros = ", ".join(f"{d(0.0)} AS {m}" for m in LOG)
    return f"""bounds AS (SELECT CAST(min(date) AS DATE) AS d0, CAST(max(date) AS DATE) AS d1 FROM {readings}),
days AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS TIMESTAMP) AS date FROM bounds),
virt AS (SELECT id_capteur AS capteur, logement FROM capteur WHERE NOT reel),
mins AS (
  SELECT DISTINCT c.logement, r.date
  FROM {readings} r JOIN capteur c ON r.capteur = c.id_capteur, bounds
  WHERE r.date >= CAST(d0 AS TIMESTAMP) AND r.date < CAST(d1 AS TIMESTAMP) + INTERVAL 1 DAY
    AND r.date = date_trunc('minute', r.date) AND r.date <> date_trunc('day', r.date)),
ghost AS (
  SELECT capteur, date, {zeros} FROM (
    SELECT v.capteur, d.date FROM virt v CROSS JOIN days d
    UNION ALL
    SELECT v.capteur, m.date FROM virt v JOIN mins m ON v.logement = m.logement))"""


def household(brut: str) -> str:
    """The household transform, shaped like the original: per-row stages,
    group aggregates joined back, maxima joined back."""
    wc = "coalesce(contains(piece, 'WC'), false)"
    bouche = "coalesce(type = 'Bouche', false)"
    ea = "coalesce(type = 'EA', false)"
    return f"""rd AS (
  SELECT b.rid, b.capteur, b.date, b.temperature AS raw_t, b.hr AS raw_hr, b.debit_position_1 AS raw_p1,
         b.debit_pression_1 AS raw_q1, b.co2 AS raw_co2, c.logement, c.piece, c.type, c.reel
  FROM {brut} b JOIN capteur c ON b.capteur = c.id_capteur
  WHERE c.logement IS NOT NULL AND b.date IS NOT NULL),
ftd AS (SELECT capteur_facteur, max(fct1) AS fct1 FROM ft GROUP BY capteur_facteur),
s1 AS (
  SELECT rd.*, CASE WHEN reel THEN {d(0.01)} * raw_t - ftd.fct1 ELSE {d(0.0)} END AS t1
  FROM rd LEFT JOIN ftd ON rd.capteur = ftd.capteur_facteur),
s1b AS (
  SELECT *, CASE WHEN reel THEN (t1 - {d(25.0)}) * ({d(0.01)} + {d(0.00008)} * raw_hr) + {d(0.0405)} * raw_hr
                               + {d(-0.0000028)} * (raw_hr * raw_hr) - {d(4.0)}
                 ELSE {d(0.0)} END AS h1
  FROM s1),
m1 AS (SELECT logement, date, {exact_mean('t1')} AS tm, {exact_mean('h1')} AS hm FROM s1b GROUP BY logement, date),
s2 AS (
  SELECT s1b.*, CASE WHEN reel THEN t1 ELSE tm END AS temperature, CASE WHEN reel THEN h1 ELSE hm END AS hr
  FROM s1b JOIN m1 ON s1b.logement = m1.logement AND s1b.date = m1.date),
fp1d AS (SELECT capteur_facteur, max(fct1) AS fct1 FROM fp1 GROUP BY capteur_facteur),
s3 AS (
  SELECT s2.*,
         CASE WHEN reel THEN (CASE WHEN {wc} THEN {d(0.0)}
                                   ELSE raw_p1 / {d(1023.0)} * {d(2.5)} - coalesce(fp1d.fct1, {d(0.0)}) END)
              ELSE {d(0.0)} END AS dpo1,
         CASE WHEN reel THEN raw_q1 / {d(1023.0)} * {d(4.5)} ELSE {d(0.0)} END AS dpe1,
         CASE WHEN reel AND coalesce(type IN ('EA', 'Station'), false) THEN raw_co2 * {d(2000.0)} / {d(818.0)}
              ELSE {d(0.0)} END AS co2c,
         CASE WHEN reel THEN raw_p1 ELSE hr END AS key_p2
  FROM s2 LEFT JOIN fp1d ON s2.capteur = fp1d.capteur_facteur),
p2 AS (
  SELECT capteur_facteur, coalesce(borne_inf, 0.0) AS borne_inf, coalesce(borne_sup, 0.0) AS borne_sup,
         coalesce(fct1, 0.0) AS fct1, coalesce(fct2, 0.0) AS fct2, coalesce(fct3, 0.0) AS fct3,
         coalesce(fct4, 0.0) AS fct4, coalesce(valeur_defaut, 0.0) AS valeur_defaut
  FROM fp2),
s4 AS (
  SELECT s3.*, b.capteur_facteur IS NOT NULL AS p2_m, b.fct1 AS p2_f1, b.fct2 AS p2_f2, b.fct3 AS p2_f3,
         b.fct4 AS p2_f4, b.valeur_defaut AS p2_vd,
         row_number() OVER (PARTITION BY s3.logement, s3.date, s3.capteur, s3.rid
                            ORDER BY b.borne_inf DESC NULLS LAST, b.borne_sup DESC NULLS LAST, b.fct1 DESC NULLS LAST,
                                     b.fct2 DESC NULLS LAST, b.fct3 DESC NULLS LAST, b.fct4 DESC NULLS LAST,
                                     b.valeur_defaut DESC NULLS LAST) AS rk
  FROM s3 LEFT JOIN p2 b ON s3.capteur = b.capteur_facteur AND s3.key_p2 >= b.borne_inf AND s3.key_p2 < b.borne_sup),
q2 AS (
  SELECT capteur_facteur, coalesce(borne_inf, 0.0) AS borne_inf, coalesce(borne_sup, 0.0) AS borne_sup,
         coalesce(fct1, 0.0) AS fct1, coalesce(fct2, 0.0) AS fct2, coalesce(fct3, 0.0) AS fct3
  FROM fq2),
s5 AS (
  SELECT s4.*, b.capteur_facteur IS NOT NULL AS q2_m, b.fct1 AS q2_f1, b.fct2 AS q2_f2, b.fct3 AS q2_f3,
         row_number() OVER (PARTITION BY s4.logement, s4.date, s4.capteur, s4.rid
                            ORDER BY b.borne_inf DESC NULLS LAST, b.borne_sup DESC NULLS LAST, b.fct1 DESC NULLS LAST,
                                     b.fct2 DESC NULLS LAST, b.fct3 DESC NULLS LAST) AS rk2
  FROM (SELECT * FROM s4 WHERE rk = 1) s4
  LEFT JOIN q2 b ON s4.capteur = b.capteur_facteur AND s4.raw_p1 >= b.borne_inf AND s4.raw_p1 < b.borne_sup),
s6 AS (
  SELECT *,
         CASE WHEN {wc} THEN {d(0.0)}
              WHEN p2_m THEN (CASE WHEN p2_vd <= {d(0.0)} THEN
                                (CASE WHEN reel THEN p2_f1 + p2_f2 * dpo1 + p2_f3 * pow(dpo1, {d(2.0)}) + p2_f4 * pow(dpo1, {d(3.0)})
                                      ELSE p2_f1 * hr + p2_f2 END)
                               ELSE p2_vd END)
              ELSE {d(0.0)} END AS dpo2,
         CASE WHEN NOT {bouche} THEN {d(0.0)}
              WHEN q2_m THEN q2_f1 + q2_f2 * dpe1 + q2_f3 * (dpe1 * dpe1)
              ELSE {d(0.0)} END AS dpe2
  FROM s5 WHERE rk2 = 1),
s7 AS (
  SELECT *, CASE WHEN {bouche} AND NOT {wc} THEN ({d(1.0)} + dpe2) * dpo2 ELSE dpo2 END AS dp
  FROM s6),
s8 AS (
  SELECT *,
         hr / {d(100.0)} * exp({d(18.8161)} - {d(4110.34)} / nullif(temperature + {d(235.0)}, {d(0.0)})) AS ha,
         CASE WHEN {ea} THEN dp / sqrt({d(2.0)}) ELSE {d(0.0)} END AS seq
  FROM s7),
g1 AS (SELECT logement, date, {exact_sum('dp')} AS s_dp, {exact_sum('seq')} AS s_seq FROM s8 GROUP BY logement, date),
s9 AS (
  SELECT s8.*, CASE WHEN {bouche} THEN g1.s_dp ELSE {d(0.0)} END AS sde_row,
         CASE WHEN {ea} THEN g1.s_seq ELSE {d(0.0)} END AS a4_row
  FROM s8 JOIN g1 ON s8.logement = g1.logement AND s8.date = g1.date),
fsd AS (SELECT logement_facteur, max(fct1) AS fct1 FROM fs GROUP BY logement_facteur),
s10 AS (
  SELECT s9.*, CASE WHEN {ea} THEN fsd.fct1 + dp ELSE {d(0.0)} END AS sse_row
  FROM s9 LEFT JOIN fsd ON s9.logement = fsd.logement_facteur),
g2 AS (SELECT logement, date, max(sde_row) AS sde, max(sse_row) AS sse FROM s10 GROUP BY logement, date),
fin AS (
  SELECT s10.*, g2.sde, g2.sse, g2.sde / nullif(g2.sse * g2.sse, {d(0.0)}) AS pr
  FROM s10 JOIN g2 ON s10.logement = g2.logement AND s10.date = g2.date)"""


def household_output(extra: str = "") -> str:
    cols = [
        "capteur",
        "date",
        f"{r4('temperature')} AS temperature",
        f"{r4('hr')} AS hr",
        f"{r4('dpo1')} AS debit_position_1",
        f"{r4('dpe1')} AS debit_pression_1",
        f"{r4('co2c')} AS co2",
        f"{r4('dpo2')} AS debit_position_2",
        f"{r4('dpe2')} AS debit_pression_2",
        f"{r4('dp')} AS debit_produit",
        f"{r4('seq')} AS surface_equivalente_ea",
        f"{r4('pr')} AS pression_reelle",
        f"{r4(f'sse * sqrt(pr / {d(10.0)})')} AS debit_reelle",
        f"{r4('ha')} AS humidite_absolue",
        f"{r4('sde')} AS somme_debits_extraits",
        f"{r4('sse')} AS somme_surface_equivalente",
    ]
    if extra:
        cols.append(extra)
    return "SELECT " + ",\n       ".join(cols) + "\nFROM fin"


def _r(cols) -> str:
    return ", ".join(f"{r4(c)} AS {c}" for c in cols)


def station_wind(src: str) -> str:
    """F13/F14/F17/F18 on repaired station counts."""
    sectors = [
        ("Nord Est", 22.5, 67.5),
        ("Est", 67.5, 112.5),
        ("Sud Est", 112.5, 157.5),
        ("Sud", 157.5, 202.5),
        ("Sud Ouest", 202.5, 247.5),
        ("Ouest", 247.5, 292.5),
        ("Nord Ouest", 292.5, 337.5),
    ]
    sector_sql = "\n".join(f"              WHEN o >= {lo} AND o < {hi} THEN '{lab}'" for lab, lo, hi in sectors)
    classes = [(0.5, "<0.5 m/s"), (2.0, "0.5-2 m/s"), (4.0, "2-4 m/s"), (6.0, "4-6 m/s"), (8.0, "6-8 m/s"), (10.0, "8-10 m/s")]
    class_sql = "\n".join(f"              WHEN v < {b} THEN '{lab}'" for b, lab in classes)
    return f"""deg AS (
  SELECT *, floor(orientation / {d(1023.0)} * {d(360.0)} + {d(0.5)}) AS o_raw,
         vitesse_vent / {d(1023.0)} * {d(2.1)} * {d(207.5)} / {d(2.1)} + {d(2.5)} AS v
  FROM {src}),
wind AS (
  SELECT *, CAST(CASE WHEN o_raw >= 360 THEN 0 ELSE o_raw END AS INTEGER) AS o
  FROM deg),
wind2 AS (
  SELECT *,
         CASE WHEN o IS NULL THEN NULL
              WHEN o <= 22.5 OR o > 337.5 THEN 'Nord'
{sector_sql}
              ELSE '' END AS bousole,
         CASE WHEN v IS NULL THEN NULL
{class_sql}
              ELSE '>10 m/s' END AS tranche_vent
  FROM wind)"""


STATION_DAY = fill("st", "raw", STATION, "capteur, CAST(date AS DATE)")
CAISSON_DAY = fill("ca", "raw", CAISSON, "capteur, CAST(date AS DATE)")

INGEST = f"""ing AS (
  SELECT l.rid, l.file_name, regexp_extract(l.file_name, '(\\S+) le (\\d{{2}} \\d{{2}} \\d{{4}})\\.acq$', 1) AS capteur,
         try_strptime(l."Date", '%d/%m/%Y %H:%M') AS date,
         {", ".join(f"r.{m}" for m in LOG)}
  FROM lines l JOIN raw r ON l.rid = r.rid),
ingf AS (
  SELECT rid, file_name, capteur, date,
         {", ".join(f"last_value(nullif({m}, {E}) IGNORE NULLS) OVER w AS {m}" for m in LOG)}
  FROM ing
  WINDOW w AS (PARTITION BY file_name ORDER BY date ASC NULLS FIRST, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

HOUSEHOLD_RE = r".+(162|093|088|182|177|223)+ le \d{2} \d{2} \d{4}\.acq$"
CAISSON_RE = r"caisson+.+le \d{2} \d{2} \d{4}\.acq$"
STATION_RE = r"Station météo+.+le \d{2} \d{2} \d{4}\.acq$"
BOX_RE = r"(\S+) le (\d{2} \d{2} \d{4})\.acq$"


def _brut_stages() -> str:
    return with_(RAW, *DIMS, BRUT, household("brut"))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    log_r = _r(LOG)

    q["ingest_readings"] = with_(RAW, LINES, INGEST) + f"SELECT rid, file_name, capteur, date, {log_r} FROM ingf"
    q["file_routing"] = with_(LINES) + f"""SELECT file_name,
       regexp_matches(file_name, '{HOUSEHOLD_RE}') AS is_logement,
       regexp_matches(file_name, '{CAISSON_RE}') AS is_caisson,
       regexp_matches(file_name, '{STATION_RE}') AS is_station,
       regexp_extract(file_name, '{BOX_RE}', 1) AS box,
       CAST(try_strptime(nullif(regexp_extract(file_name, '{BOX_RE}', 2), ''), '%d %m %Y') AS DATE) AS file_day
FROM (SELECT DISTINCT file_name FROM lines)"""
    q["parse_timestamp"] = with_(LINES) + """SELECT rid, "Date" AS date_text, try_strptime("Date", '%d/%m/%Y %H:%M') AS date FROM lines"""
    q["day_slice"] = with_(RAW) + f"""SELECT rid, capteur, date, {log_r} FROM raw
WHERE date >= TIMESTAMP '{SAMPLE_DAY} 00:00:00' AND date < TIMESTAMP '{NEXT_DAY} 00:00:00'"""
    q["day_replace"] = with_(RAW, BRUT_DAY) + f"""SELECT rid, capteur, date, {log_r}, CAST(date AS DATE) AS day FROM raw
WHERE NOT (date >= TIMESTAMP '{SAMPLE_DAY} 00:00:00' AND date < TIMESTAMP '{DAY_AFTER} 00:00:00')
UNION ALL
SELECT rid, capteur, date, {log_r}, CAST(date AS DATE) AS day FROM brut_day
WHERE date >= TIMESTAMP '{SAMPLE_DAY} 00:00:00' AND date < TIMESTAMP '{NEXT_DAY} 00:00:00'"""
    q["batch_day"] = with_(LINES) + """SELECT file_name, min(try_strptime("Date", '%d/%m/%Y %H:%M')) AS batch_start,
       CAST(min(try_strptime("Date", '%d/%m/%Y %H:%M')) AS DATE) AS batch_day
FROM lines GROUP BY file_name"""
    q["range_run"] = (
        with_(
            RAW,
            *DIMS,
            BRUT,
            ghosts("raw"),
            f"brut_all AS (SELECT rid, capteur, date, {', '.join(LOG)} FROM brut "
            f"UNION ALL SELECT NULL AS rid, capteur, date, {', '.join(LOG)} FROM ghost)",
            household("brut_all"),
        )
        + household_output("CAST(date AS DATE) AS day")
    )

    q["lag_previous"] = with_(RAW) + f"""SELECT rid, capteur, date, {r4('temperature')} AS temperature, {r4('hr')} AS hr,
       {r4('lag(temperature) OVER w')} AS temperature_prev, {r4('lag(hr) OVER w')} AS hr_prev
FROM raw WINDOW w AS (PARTITION BY capteur, CAST(date AS DATE) ORDER BY date, rid)"""
    q["sentinel_repair"] = with_(RAW, BRUT_DAY) + f"SELECT rid, capteur, date, {log_r} FROM brut_day"
    q["sentinel_seeded"] = with_(RAW, BRUT) + f"SELECT rid, capteur, date, {log_r} FROM brut"
    q["virtual_readings"] = with_(RAW, CAPTEUR, ghosts("raw")) + f"SELECT capteur, date, {log_r} FROM ghost"
    q["virtual_fill"] = _brut_stages() + f"""SELECT rid, capteur, logement, date, reel, {r4('temperature')} AS temperature,
       {r4('hr')} AS hr FROM s2"""

    q["join_sensor_dim"] = with_(RAW, CAPTEUR) + f"""SELECT r.rid, r.capteur, r.date, {', '.join(f'{r4("r." + m)} AS {m}' for m in LOG)},
       c.logement, c.piece, c.type, c.reel
FROM raw r JOIN capteur c ON r.capteur = c.id_capteur"""
    q["missing_factors"] = with_(RAW, CAPTEUR, FT, FS) + """, rd AS (SELECT r.capteur, c.logement, c.type, c.reel FROM raw r JOIN capteur c ON r.capteur = c.id_capteur)
SELECT 'facteur_temperature' AS factor_table, k.key FROM (SELECT DISTINCT capteur AS key FROM rd WHERE reel) k
WHERE NOT EXISTS (SELECT 1 FROM ft WHERE ft.capteur_facteur = k.key)
UNION ALL
SELECT 'facteur_somme_surface_equivalente' AS factor_table, k.key
FROM (SELECT DISTINCT logement AS key FROM rd WHERE type = 'EA' AND logement IS NOT NULL) k
WHERE NOT EXISTS (SELECT 1 FROM fs WHERE fs.logement_facteur = k.key)
UNION ALL
SELECT 'facteur_temperature (station)' AS factor_table, k.key FROM (SELECT DISTINCT capteur AS key FROM raw) k
WHERE NOT EXISTS (SELECT 1 FROM ft WHERE ft.capteur_facteur = k.key)"""
    q["missing_factors"] = q["missing_factors"].replace("\n, rd AS", ",\nrd AS")
    q["calibrate_climate"] = _brut_stages() + f"""SELECT rid, capteur, date, {r4('t1')} AS temperature, {r4('h1')} AS hr,
       {r4(f"CASE WHEN reel AND coalesce(type IN ('EA', 'Station'), false) THEN raw_co2 * {d(2000.0)} / {d(818.0)} ELSE {d(0.0)} END")} AS co2
FROM s1b"""
    q["calibrate_flow"] = _brut_stages() + f"""SELECT rid, capteur, date, {r4('dpo1')} AS debit_position_1, {r4('dpe1')} AS debit_pression_1,
       {r4('dp')} AS debit_produit, {r4('seq')} AS surface_equivalente_ea FROM s8"""
    q["band_lookup"] = _brut_stages() + f"""SELECT rid, capteur, date, {r4('dpo2')} AS debit_position_2, {r4('dpe2')} AS debit_pression_2 FROM s8"""
    q["absolute_humidity"] = _brut_stages() + f"SELECT rid, capteur, date, {r4('ha')} AS humidite_absolue FROM s8"

    q["household_mean"] = _brut_stages() + f"SELECT logement, date, {r4('tm')} AS temperature_moyenne, {r4('hm')} AS hr_moyen FROM m1"
    q["household_flow_sum"] = _brut_stages() + f"SELECT rid, capteur, logement, date, type, {r4('sde_row')} AS somme_debits_extraits FROM s9"
    q["household_surface_sum"] = _brut_stages() + f"SELECT rid, capteur, logement, date, type, {r4('a4_row')} AS somme_surface_equivalente FROM s9"
    q["household_balance"] = _brut_stages() + household_output()
    q["household_balance_placed"] = q["household_balance"]
    q["daily_real_hr"] = _brut_stages() + f"""SELECT CAST(dayofyear(date) AS INTEGER) AS jour, logement, {r4(exact_mean('h1'))} AS hr_moyen
FROM s1b WHERE reel GROUP BY dayofyear(date), logement"""
    # the sample day was replaced by its first twelve hours
    q["daily_hr_partials"] = _brut_stages() + f"""SELECT CAST(dayofyear(date) AS INTEGER) AS jour, logement,
       {r4(exact_mean('t1'))} AS temperature_moyenne, {r4(exact_mean('h1'))} AS hr_moyen, count(h1) AS mesures_hr
FROM s1b WHERE reel AND NOT (CAST(date AS DATE) = DATE '{SAMPLE_DAY}' AND hour(date) >= 12)
GROUP BY dayofyear(date), logement"""

    q["wind_sector"] = with_(RAW, STATION_DAY, station_wind("st")) + "SELECT rid, capteur, date, o AS orientation, bousole FROM wind2"
    q["wind_speed_class"] = with_(RAW, STATION_DAY, station_wind("st")) + f"SELECT rid, capteur, date, {r4('v')} AS vitesse_vent, tranche_vent FROM wind2"
    q["weather_station"] = with_(
        RAW,
        FT,
        STATION_DAY,
        "ftd AS (SELECT capteur_facteur, max(fct1) AS fct1 FROM ft GROUP BY capteur_facteur)",
        f"""cal AS (
  SELECT st.rid, st.capteur, st.date, st.orientation, st.vitesse_vent, st.co2, st.hr AS raw_hr,
         {d(0.01)} * st.temperature - ftd.fct1 AS temperature
  FROM st LEFT JOIN ftd ON st.capteur = ftd.capteur_facteur)""",
        station_wind("cal"),
    ) + f"""SELECT date, {r4('temperature')} AS temperature,
       {r4(f"(temperature - {d(25.0)}) * ({d(0.01)} + {d(0.00008)} * raw_hr) + {d(0.0405)} * raw_hr + {d(-0.0000028)} * (raw_hr * raw_hr) - {d(4.0)}")} AS hr,
       o AS orientation, {r4('v')} AS vitesse_vent, {r4(f'co2 * {d(2000.0)} / {d(818.0)}')} AS co2,
       bousole, capteur, tranche_vent
FROM wind2"""
    q["calibrate_fanbox"] = with_(RAW, CAISSON_DAY) + f"""SELECT date, {r4(f'{d(1.1122)} * puissance - {d(5.4133)}')} AS puissance,
       {r4(f'{d(0.7177)} * pression - {d(43.485)}')} AS pression, {d(0.0)} AS consommation, capteur FROM ca"""
    return q
