"""Shared pieces of the checking SQL (DuckDB dialect).

The SQL takes the long way round on purpose: windows instead of aggregates,
range joins instead of computed keys, a full unpivot ahead of every count.
"""

from __future__ import annotations

from collections.abc import Sequence

from conformance import testbed as tb
from labwatch import vocab
from labwatch.vocab import PATHOGENS, RESULT_COLUMNS

AS_OF = f"DATE '{tb.AS_OF}'"
NOW_LOCAL = "TIMESTAMP '2026-02-15 09:00:00'"


def norm(expr: str) -> str:
    """Upper case, no accents, no outer blanks, then no outer tabs and backslashes."""
    return f"trim(trim(upper(strip_accents(replace({expr}, 'ß', 'ss'))), ' '), chr(9) || chr(92))"


def values(name: str, columns: Sequence[str], rows: Sequence[tuple]) -> str:
    body = ", ".join("(" + ", ".join(tb.quote(v) for v in r) + ")" for r in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


def in_list(names: Sequence[str]) -> str:
    return "(" + ", ".join(tb.quote(n) for n in names) + ")"


def case_map(expr: str, mapping: dict, default: str = "NULL") -> str:
    body = " ".join(f"WHEN {tb.quote(k)} THEN {tb.quote(v)}" for k, v in mapping.items())
    return f"CASE {expr} {body} ELSE {default} END"


def state_case(expr: str) -> str:
    return case_map(expr, vocab.STATE_NAMES)


def hot_columns(analytes: dict, source: str, result: str = "result") -> str:
    parts = []
    for p in PATHOGENS:
        names = analytes.get(p)
        cond = f"CASE WHEN {source} IN {in_list(names)} THEN {result} ELSE -1 END" if names else "-1"
        parts.append(f"{cond} AS {p}_test_result")
    return ", ".join(parts)


def tie_break(carried: Sequence[str], first: Sequence[str] = ("date_testing", "file_name")) -> str:
    order = [c for c in first if c in carried] + [c for c in carried if c not in first]
    return ", ".join(f'"{c}" NULLS FIRST' for c in order)


def filled(source: str, carried: Sequence[str], count_lines: bool = True, out: str = "samples") -> str:
    """CTEs that label each row with its sample's maxima and keep one row per sample."""
    labels = ", ".join(
        f"CASE MAX({c}) OVER w WHEN 1 THEN 'Pos' WHEN 0 THEN 'Neg' WHEN -1 THEN 'NT' END AS {c}" for c in RESULT_COLUMNS
    )
    lines = "COUNT(*) OVER w" if count_lines else "CAST(1 AS BIGINT)"
    return (
        f"{out}_filled AS (SELECT sample_id, {', '.join(carried)}, {labels}, {lines} AS qty_original_lines, "
        f"ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY {tie_break(carried)}) AS rn "
        f"FROM {source} WINDOW w AS (PARTITION BY sample_id)), "
        f"{out} AS (SELECT * EXCLUDE (rn) FROM {out}_filled WHERE rn = 1)"
    )


AGE_GROUPS = values("age_groups", ["age_group", "min_age", "max_age"], vocab.AGE_BANDS)
METHODS = values("methods", ["test_kit", "test_method"], list(vocab.TEST_METHODS.items()))
FIX_STATE = values("fix_state", ["source_state", "target_state"], list(vocab.STATE_FIXES.items()))
FIX_LOCATION = values(
    "fix_location", ["source_location", "source_state", "target_location"],
    [(loc, st, target) for (loc, st), target in vocab.LOCATION_FIXES.items()],
)
EPIWEEKS = (
    "epiweeks AS (SELECT year(d + INTERVAL 3 DAY) AS year, CAST(ROW_NUMBER() OVER (PARTITION BY year(d + INTERVAL 3 DAY) ORDER BY d) AS INTEGER) AS week_num, "
    "CAST(d + INTERVAL 6 DAY AS DATE) AS end_date, CAST(d AS DATE) AS start_date "
    "FROM generate_series(TIMESTAMP '2017-12-31', TIMESTAMP '2027-12-26', INTERVAL 7 DAY) AS g(d))"
)
DIMENSIONS = ", ".join([AGE_GROUPS, METHODS, FIX_STATE, FIX_LOCATION, EPIWEEKS, tb.DUCK_GEOGRAPHY])

CARRIED = [
    "lab_id", "test_id", "test_kit", "sex", "age", "location", "state", "date_testing", "patient_id", "file_name",
]
LONG = f"long_rows AS ({tb.duck(tb.LONG)})"
HOT = (
    "hot AS (SELECT *, md5(concat(test_id, test_kit)) AS sample_id, "
    + hot_columns({p: [p] for p in PATHOGENS}, "analyte")
    + " FROM long_rows)"
)
SAMPLES = ", ".join([tb.DUCK_TESTS, LONG, HOT, filled("hot", CARRIED)])

_SKIP = "EXCLUDE (location, state)"


def enriched(source: str) -> str:
    """CTEs from samples to panel; the last is ``panel``."""
    return f"""
with_method AS (SELECT s.*, m.test_method FROM {source} s LEFT JOIN methods m ON s.test_kit = m.test_kit
  WHERE s.date_testing >= DATE '{vocab.PANEL_START}'),
with_age AS (SELECT s.*, g.age_group FROM with_method s LEFT JOIN age_groups g ON s.age >= g.min_age AND s.age <= g.max_age),
with_week AS (SELECT s.*, w.end_date AS epiweek_enddate, w.week_num AS epiweek_number, strftime(s.date_testing, '%Y-%m') AS month
  FROM with_age s LEFT JOIN epiweeks w ON s.date_testing >= w.start_date AND s.date_testing <= w.end_date),
clean AS (SELECT * {_SKIP}, {norm('location')} AS location, {norm('state')} AS state FROM with_week),
fixed AS (SELECT c.* {_SKIP}, COALESCE(fl.target_location, c.location) AS location, COALESCE(fs.target_state, c.state) AS state
  FROM clean c LEFT JOIN fix_state fs ON c.state ILIKE fs.source_state
  LEFT JOIN fix_location fl ON c.location ILIKE fl.source_location AND (c.state ILIKE fl.source_state OR fs.target_state ILIKE fl.source_state)),
panel AS (SELECT f.* {_SKIP}, m.NM_MUN AS location, m.NM_UF AS state, 'Brasil' AS country,
  {case_map('m.REGIAO', vocab.REGION_LABELS)} AS region, r.DS_NOMEPAD_macsaud AS macroregion, r.CO_MACSAUD AS macroregion_code,
  m.SIGLA_UF AS state_code, m.CD_UF AS state_ibge_code, m.CD_MUN AS location_ibge_code, m.lat, m.long
  FROM fixed f LEFT JOIN municipalities m ON f.location LIKE m.NM_MUN_NORM AND f.state LIKE m.NM_UF_NORM
  LEFT JOIN macroregions r ON m.CD_UF = r.CO_UF AND ('BR' || CAST(m.CD_MUN AS VARCHAR)) = r.ADM2_PCODE)"""


PANEL = f"{SAMPLES}, {DIMENSIONS}, {enriched('samples')}"

_LABELLED = ", ".join(f"COALESCE({c}, 'NOT REPORTED') AS {c}" for c in ["location", "state", "state_code", "region", "country", "age_group"])
_TUPLES = ", ".join(f"(r.{p}_test_result, '{p}')" for p in PATHOGENS)
ROWS = (
    "rows_ AS (SELECT sample_id, test_kit, epiweek_enddate, date_testing, month, epiweek_number, lab_id, location_ibge_code, lat, long, "
    f"{_LABELLED}, {', '.join(RESULT_COLUMNS)} FROM panel WHERE epiweek_enddate < {AS_OF} AND epiweek_enddate > DATE '2022-01-01')"
)
UP = f"up AS (SELECT r.*, u.result, u.pathogen FROM rows_ r CROSS JOIN LATERAL (VALUES {_TUPLES}) AS u(result, pathogen))"
UNPIVOTED = f"{PANEL}, {ROWS}, {UP}"


def metrics(result: str = "result") -> str:
    pos = f"SUM(CASE WHEN {result} = 'Pos' THEN 1 ELSE 0 END)"
    total = f"SUM(CASE WHEN {result} IN ('Pos', 'Neg') THEN 1 ELSE 0 END)"
    return (
        f"CAST({pos} AS BIGINT) AS pos, CAST(SUM(CASE WHEN {result} = 'Neg' THEN 1 ELSE 0 END) AS BIGINT) AS neg, "
        f"CAST({total} AS BIGINT) AS totaltests, CASE WHEN {total} >= 50 THEN CAST({pos} AS DOUBLE) / {total} END AS posrate"
    )


# -- register ----------------------------------------------------------------


def _int(c: str) -> str:
    return f"CAST(round(TRY_CAST({c} AS DECIMAL(38, 6))) AS INTEGER)"


_N = {c: _int(c) for c in [
    "NU_IDADE_N", "TP_IDADE", "CO_MUN_RES", "AMOSTRA", "CLASSI_FIN", "TP_FLU_AN", "POS_AN_FLU", "AN_SARS2", "AN_VSR", "AN_PARA1",
    "AN_PARA2", "AN_PARA3", "AN_ADENO", "POS_PCRFLU", "TP_FLU_PCR", "PCR_SARS2", "PCR_VSR", "PCR_PARA1", "PCR_PARA2", "PCR_PARA3",
    "PCR_PARA4", "PCR_ADENO", "PCR_METAP", "PCR_BOCA", "PCR_RINO",
]}
_FLU = "CASE WHEN {t} = {k} AND {p} = 1 THEN 1 WHEN {t} = {k} AND {p} = 2 THEN 0 END"
_KITS = [
    ("flua_antigen", "flua", _FLU.format(t="TP_FLU_AN", p="POS_AN_FLU", k=1)),
    ("flub_antigen", "flub", _FLU.format(t="TP_FLU_AN", p="POS_AN_FLU", k=2)),
    ("covid_antigen", "covid", "AN_SARS2"), ("vsr_antigen", "vsr", "AN_VSR"),
    ("para_antigen", "para", "CASE WHEN AN_PARA1 = 1 OR AN_PARA2 = 1 OR AN_PARA3 = 1 THEN 1 END"),
    ("adeno_antigen", "adeno", "AN_ADENO"),
    ("flua_pcr", "flua", _FLU.format(t="TP_FLU_PCR", p="POS_PCRFLU", k=1)),
    ("flub_pcr", "flub", _FLU.format(t="TP_FLU_PCR", p="POS_PCRFLU", k=2)),
    ("covid_pcr", "covid", "PCR_SARS2"), ("vsr_pcr", "vsr", "PCR_VSR"), ("adeno_pcr", "adeno", "PCR_ADENO"),
    ("meta_pcr", "meta", "PCR_METAP"), ("boca_pcr", "boca", "PCR_BOCA"), ("rino_pcr", "rino", "PCR_RINO"),
    ("para_pcr", "para", "CASE WHEN PCR_PARA1 = 1 OR PCR_PARA2 = 1 OR PCR_PARA3 = 1 OR PCR_PARA4 = 1 THEN 1 END"),
]
REGISTER_CARRIED = [
    "test_id", "test_kit", "sex", "age", "location", "state", "date_testing", "date_pri_sin", "patient_id", "file_name",
]
_REGISTER_ANALYTES = {"SC2": ["covid"], "FLUA": ["flua"], "FLUB": ["flub"], "VSR": ["vsr"], "META": ["meta"], "RINO": ["rino"],
                      "PARA": ["para"], "ADENO": ["adeno"], "BOCA": ["boca"]}
REGISTER_LONG = f"""
{tb.DUCK_CASES}, reg_raw AS ({tb.duck(tb.REGISTER)}),
reg_typed AS (SELECT NM_UN_INTE, CS_SEXO, {norm('ID_MN_RESI')} AS location, {norm('SG_UF')} AS sg_uf, TRY_CAST(DT_COLETA AS DATE) AS date_testing,
  TRY_CAST(DT_SIN_PRI AS DATE) AS date_pri_sin, {', '.join(f'{v} AS {k}' for k, v in _N.items())}, file_name FROM reg_raw),
reg_cases AS (SELECT *, CASE WHEN CS_SEXO NOT IN ('F', 'M') THEN NULL ELSE CS_SEXO END AS sex,
  CASE WHEN TP_IDADE IN (1, 2) THEN 0 WHEN TP_IDADE = 3 THEN NU_IDADE_N END AS age, {state_case('sg_uf')} AS state
  FROM reg_typed WHERE AMOSTRA = 1 AND CLASSI_FIN != 4 AND location IS NOT NULL AND date_testing <= {AS_OF} AND date_testing IS NOT NULL),
reg_long AS (SELECT md5(concat(c.NM_UN_INTE, c.CO_MUN_RES, c.date_testing, c.age, c.sex, k.test_kit)) AS sample_id, c.sex, c.age,
  c.CO_MUN_RES AS co_mun_res, c.location, c.state, c.date_testing, c.date_pri_sin, k.test_kit, k.pathogen, k.result, c.file_name FROM reg_cases c
  CROSS JOIN LATERAL (VALUES {', '.join(f"('{kit}', '{p}', {expr})" for kit, p, expr in _KITS)}) AS k(test_kit, pathogen, result)
  WHERE k.result IS NOT NULL)"""
REGISTER = f"""{REGISTER_LONG},
reg_hot AS (SELECT *, sample_id AS test_id, CAST(NULL AS VARCHAR) AS patient_id, {hot_columns(_REGISTER_ANALYTES, 'pathogen')} FROM reg_long),
{filled('reg_hot', REGISTER_CARRIED, out='register_')}"""
REGISTER_ROWS = f"""
reg_rows AS (SELECT s.sample_id, s.test_kit, w.end_date AS epiweek_enddate, w.week_num AS epiweek_number, g.region, s.state,
  COALESCE(s.location, 'NOT REPORTED') AS location, m.CD_MUN AS location_ibge_code, COALESCE(a.age_group, 'NOT REPORTED') AS age_group,
  {', '.join('s.' + c for c in RESULT_COLUMNS)} FROM register_ s
  LEFT JOIN epiweeks w ON s.date_pri_sin >= w.start_date AND s.date_pri_sin <= w.end_date
  LEFT JOIN (SELECT DISTINCT {norm('state_name')} AS state_name, region FROM macroregions) g ON s.state = g.state_name
  LEFT JOIN municipalities m ON m.NM_MUN_NORM = s.location AND m.NM_UF_NORM = s.state
  LEFT JOIN age_groups a ON s.age >= a.min_age AND s.age <= a.max_age
  WHERE w.end_date < {AS_OF} AND w.end_date >= DATE '2022-01-01'),
reg_up AS (SELECT r.*, u.result, u.pathogen FROM reg_rows r CROSS JOIN LATERAL (VALUES {_TUPLES}) AS u(result, pathogen))"""
UNPIVOTED_BOTH = f"{UNPIVOTED}, {REGISTER}, {REGISTER_ROWS}"
