"""Checking SQL of the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from conformance import testbed as tb
from conformance.oracle_base import AS_OF, UNPIVOTED, UNPIVOTED_BOTH, in_list, metrics
from labwatch import vocab
from labwatch.vocab import PATHOGEN_LABELS, REGIONS

W = "epiweek_enddate"
L = PATHOGEN_LABELS
FOUR = ["FLUA", "FLUB", "SC2", "VSR"]
SC2, FLU, VSR = vocab.SC2_KITS, vocab.FLU_KITS, vocab.VSR_KITS


def route(*branches: tuple[str, Sequence[str]]) -> str:
    body = " ".join(f"WHEN {p}_test_result IN ('Pos', 'Neg') THEN test_kit IN {in_list(k)}" for p, k in branches)
    return f"CASE {body} ELSE FALSE END"


R01 = route(("SC2", vocab.SC2_ROUTED_KITS), ("FLUA", FLU), ("FLUB", FLU), ("VSR", VSR))
R4 = route(*[(p, vocab.PANEL4_KITS) for p in ("SC2", "FLUA", "FLUB", "VSR")])
_W4 = vocab.WIDE_KITS
R06 = route(
    ("COVS", _W4), ("ADENO", [*_W4, "adeno_pcr"]), ("BOCA", ["test_14", "test_23", "test_24"]), ("RINO", _W4), ("PARA", _W4),
    ("ENTERO", _W4), ("META", _W4), ("BAC", ["test_21", "test_23", "test_24", "bac_pcr", "bac_antigen"]),
)
_LP = ["test_21", "test_23", "test_24"]
PYR = ["SC2", "FLUA", "FLUB", "VSR", "COVS", "ADENO", "BOCA", "RINO", "PARA", "ENTERO", "META", "BAC"]
R09 = route(*[(p, ["test_21", "test_24"] if p == "COVS" else ["test_23", "test_24"] if p == "BOCA" else _LP) for p in PYR])


def grouped(keys: str, where: str, source: str = "up") -> str:
    return f"g AS (SELECT {keys}, pathogen, {metrics()} FROM {source} WHERE {where} GROUP BY ALL)"


def max_rate(p: str, name: str) -> str:
    return f"MAX(CASE WHEN pathogen = '{p}' THEN posrate * 100 END) AS \"{name}\""


def sum_pos(p: str, name: str) -> str:
    return f"CAST(SUM(CASE WHEN pathogen = '{p}' THEN pos ELSE 0 END) AS INTEGER) AS \"{name}\""


def lines(pathogens: Sequence[str], where: str) -> str:
    cols = ", ".join(max_rate(p, L[p]) for p in pathogens)
    return f"{grouped(W, where)}, t AS (SELECT {W} AS \"semana epidemiológica\", {cols} FROM g GROUP BY {W})"


def bars(pathogens: Sequence[str], where: str, keys: dict[str, str]) -> str:
    cols = ", ".join(sum_pos(p, L[p]) for p in pathogens)
    names = ", ".join(f'{k} AS "{n}"' for k, n in keys.items())
    return f"{grouped(', '.join(keys), where)}, t AS (SELECT {names}, {cols} FROM g GROUP BY {', '.join(keys)})"


def heat(p: str, kits: Sequence[str], name: str) -> str:
    where = f"age_group NOT IN ('NOT REPORTED') AND test_kit IN {in_list(kits)} AND {W} >= DATE '2022-01-01'"
    pos = f"SUM(CASE WHEN pathogen = '{p}' THEN pos ELSE 0 END)"
    neg = f"SUM(CASE WHEN pathogen = '{p}' THEN neg ELSE 0 END)"
    return (
        f"{grouped(W + ', age_group', where)}, t AS (SELECT {W} AS \"Semana epidemiológica\", age_group AS \"Faixa etária\", {max_rate(p, name)}, "
        f"CAST({pos} + {neg} AS INTEGER) AS \"Total de testes realizados\", CAST({pos} AS INTEGER) AS \"Total de positivos\", "
        f"CAST({neg} AS INTEGER) AS \"Total de negativos\" FROM g GROUP BY {W}, age_group)"
    )


STATE_HEAT = f"""
{grouped(W + ', state_code, region', f"test_kit IN {in_list(SC2)} AND {W} >= DATE '2022-01-01'")},
cells AS (SELECT {W}, state_code, region, MAX(CASE WHEN pathogen = 'SC2' THEN posrate * 100 END) AS percent,
  CAST(SUM(CASE WHEN pathogen = 'SC2' THEN pos ELSE 0 END) AS INTEGER) AS pos, CAST(SUM(CASE WHEN pathogen = 'SC2' THEN neg ELSE 0 END) AS INTEGER) AS neg
  FROM g GROUP BY {W}, state_code, region),
last_week AS (SELECT MAX({W}) AS w FROM cells),
recent_cells AS (SELECT * FROM cells WHERE {W} >= (SELECT w FROM last_week) - 381),
hist AS (SELECT state_code, COUNT(percent) AS filled FROM cells GROUP BY state_code),
year_ AS (SELECT state_code, COUNT(percent) AS filled FROM recent_cells GROUP BY state_code),
joined AS (SELECT c.*, h.filled AS hf, y.filled AS yf, (SELECT COUNT(DISTINCT {W}) FROM cells) AS ht, (SELECT COUNT(DISTINCT {W}) FROM recent_cells) AS yt,
  CAST(h.filled AS DOUBLE) / (SELECT COUNT(DISTINCT {W}) FROM cells) AS hs, CAST(y.filled AS DOUBLE) / (SELECT COUNT(DISTINCT {W}) FROM recent_cells) AS ys
  FROM cells c LEFT JOIN hist h ON c.state_code = h.state_code LEFT JOIN year_ y ON c.state_code = y.state_code),
t AS (SELECT {W} AS semanas_epidemiologicas, state_code AS "UF", region AS "Região", percent AS "Positividade",
  CAST(pos + neg AS INTEGER) AS "Total de testes realizados", pos AS "Total de positivos", neg AS "Total de negativos",
  CASE WHEN hs >= 0.7 THEN 'Bom Histórico' ELSE 'Ruim histórico' END AS "Completude do histórico", hs AS "Valor da completude do histórico",
  CASE WHEN ys >= 0.7 THEN 'Bom 12 meses' ELSE 'Ruim 12 meses' END AS "Completude do ano", ys AS "Valor da completude do ano",
  CASE WHEN hs >= 0.7 AND ys >= 0.7 THEN 'Alta qualidade' WHEN hs < 0.7 AND ys < 0.7 THEN 'Baixa qualidade'
    WHEN hs >= 0.7 AND ys < 0.7 THEN 'Apenas histórico' ELSE 'Apenas 12 meses' END AS "Completude final",
  CAST(ht AS INTEGER) AS "Total de semanas históricas", CAST(hf AS INTEGER) AS "Semanas históricas preenchidas",
  CAST(yt AS INTEGER) AS "Total de semanas do ano", CAST(yf AS INTEGER) AS "Semanas do ano preenchidas"
  FROM joined WHERE state_code <> 'NOT REPORTED' AND region <> 'NOT REPORTED')"""

OVERALL = f"""
g AS (SELECT {W}, {metrics()} FROM up WHERE test_kit IN {in_list(vocab.ALL_REPORTED_KITS)} GROUP BY {W}),
t AS (SELECT {W} AS semanas_epidemiologicas, posrate * 100 AS "Positividade (%)", pos AS "Positivos", neg AS "Negativos" FROM g)"""


def flat(keys: dict[str, str]) -> str:
    where = f"{R01} AND {W} >= DATE '2022-01-01' AND pathogen IN ('SC2', 'FLUA', 'FLUB', 'VSR')"
    names = ", ".join(f'{k} AS "{n}"' for k, n in keys.items())
    return (
        f"{grouped(', '.join(keys), where)}, t AS (SELECT {names}, pathogen AS \"Patógeno\", pos AS \"Testes Positivos\", neg AS \"Testes Negativos\", "
        "totaltests AS \"Total de Testes\", posrate * 100 AS \"Taxa de Positividade (%)\" FROM g)"
    )


def annual(p: str, kits: Sequence[str]) -> str:
    months = " ".join(
        f"WHEN epiweek_number >= {start} THEN '{label}'" for start, label in reversed(vocab.MONTH_LABEL_STARTS)
    )
    label = f"concat('SE', lpad(CAST(epiweek_number AS VARCHAR), 2, '0'), ' - ', CASE {months} END)"
    year = f"year(date_trunc('week', {W} + INTERVAL 1 DAY) - INTERVAL 1 DAY + INTERVAL 3 DAY)"
    cols = ", ".join(f"MAX(CASE WHEN pathogen = '{p}' AND y = {n} THEN posrate * 100 END) AS \"{n}\"" for n in range(2022, 2027))
    return (
        f"g AS (SELECT {label} AS m, {year} AS y, pathogen, {metrics()} FROM up WHERE {p}_test_result IN ('Pos', 'Neg') AND test_kit IN {in_list(kits)} GROUP BY ALL), "
        f"t AS (SELECT m AS \"semana epidemiológica  (SE)\", {cols} FROM g GROUP BY m)"
    )


def volume(bucket: str, name: str, start: str) -> str:
    cols = ", ".join(f"CAST(SUM(CASE WHEN region = '{r}' THEN n ELSE 0 END) AS BIGINT) AS \"{r}\"" for r in REGIONS)
    return (
        f"g AS (SELECT {bucket}, region, COUNT(DISTINCT sample_id) AS n FROM up WHERE {bucket} >= {start} AND test_kit IN "
        f"{in_list(vocab.ALL_REPORTED_KITS)} AND region != 'NOT REPORTED' GROUP BY ALL), "
        f"t AS (SELECT {bucket} AS \"{name}\", {cols} FROM g GROUP BY {bucket})"
    )


QUARTERS = f"""
g AS (SELECT concat(year(date_testing), ' - ', quarter(date_testing), 'º Trimestre') AS q, age_group, pathogen, {metrics()} FROM up
  WHERE test_kit IN {in_list(vocab.MULTIPLEX_KITS)} AND age_group != 'NOT REPORTED' AND date_testing >= DATE '2022-01-01'
  AND date_testing < date_trunc('quarter', {AS_OF}) GROUP BY ALL),
a AS (SELECT q, age_group, {', '.join(sum_pos(p, L[p]) for p in PYR)} FROM g GROUP BY q, age_group),
t AS (SELECT c.q AS trimestre, c.age_group AS faixas_etarias, {', '.join(f'a."{L[p]}"' for p in PYR)}
  FROM (SELECT * FROM (SELECT DISTINCT q FROM g) CROSS JOIN (SELECT DISTINCT age_group FROM g)) c
  LEFT JOIN a ON c.q = a.q AND c.age_group = a.age_group)"""


def city_map(p: str, start: str, kits: Sequence[str], place: list[tuple[str, str]], tested: bool, week: str, cases: str, total: str) -> str:
    cols = [c for c, _ in place]
    need = f"{p}_test_result IN ('Pos', 'Neg') AND " if tested else ""
    sel = ", ".join(f'"{c}" AS "{n}"' for c, n in place)
    src = ", ".join("state_code AS state" if c == "state" and ("state_code", "state") not in place and p == "SC2" else c for c in cols)
    return f"""
weeks AS (SELECT DISTINCT {W} FROM up WHERE {W} >= DATE '{start}'),
src AS (SELECT {W}, {src}, pathogen, {metrics()} FROM up WHERE {need}test_kit IN {in_list(kits)} AND {W} >= DATE '{start}' GROUP BY ALL),
places AS (SELECT DISTINCT {', '.join(cols)} FROM src),
grid AS (SELECT * FROM weeks CROSS JOIN places),
summed AS (SELECT {', '.join('e.' + c for c in [W, *cols])}, COALESCE(SUM(CASE WHEN s.pathogen = '{p}' THEN s.pos ELSE 0 END), 0) AS cases
  FROM grid e LEFT JOIN src s ON e.{W} = s.{W} AND e.location_ibge_code = s.location_ibge_code GROUP BY ALL),
pop AS (SELECT CAST(regexp_replace(ADM2_PCODE, '^BR', '') AS INTEGER) AS code, CAST(Populacao AS INTEGER) AS people FROM macroregions WHERE ADM2_PCODE ILIKE 'BR%'),
running AS (SELECT m.*, people, SUM(cases) OVER (PARTITION BY location_ibge_code ORDER BY {W}) AS total FROM summed m LEFT JOIN pop ON location_ibge_code = code),
t AS (SELECT {W} AS "{week}", {sel}, people AS "População", CAST(cases AS INTEGER) AS "{cases}", CAST(total AS INTEGER) AS "{total}",
  CAST(total AS DOUBLE) / NULLIF(people, 0) * 100000 AS "Casos por 100 mil hab." FROM running
  WHERE total > 0 AND location <> 'NOT REPORTED' AND state <> 'NOT REPORTED')"""


def state_map(p: str, start: str, kits: Sequence[str], tested: bool, week: str, names: tuple[str, str], cases: str, total: str, from_cases: bool = False) -> str:
    need = f"{p}_test_result IN ('Pos', 'Neg') AND " if tested else ""
    states = "src" if from_cases else "up"
    return f"""
weeks AS (SELECT DISTINCT {W} FROM up WHERE {W} >= DATE '{start}'),
src AS (SELECT {W}, state_code, state, pathogen, {metrics()} FROM up WHERE {need}test_kit IN {in_list(kits)} AND {W} >= DATE '{start}' GROUP BY ALL),
grid AS (SELECT * FROM weeks CROSS JOIN (SELECT DISTINCT state_code, state FROM {states} WHERE state_code IS NOT NULL)),
summed AS (SELECT e.{W}, e.state_code, e.state, COALESCE(SUM(CASE WHEN s.pathogen = '{p}' THEN s.pos ELSE 0 END), 0) AS cases
  FROM grid e LEFT JOIN src s ON e.{W} = s.{W} AND e.state_code = s.state_code GROUP BY ALL),
pop AS (SELECT DS_UF_SIGLA AS code, CAST(SUM(CAST(Populacao AS INTEGER)) AS BIGINT) AS people FROM macroregions WHERE ADM2_PCODE ILIKE 'BR%' GROUP BY ALL),
running AS (SELECT m.*, people, SUM(cases) OVER (PARTITION BY state_code ORDER BY {W}) AS total FROM summed m LEFT JOIN pop ON state_code = code),
t AS (SELECT {W} AS "{week}", state_code AS "{names[0]}", state AS "{names[1]}", people AS "População", CAST(cases AS INTEGER) AS "{cases}",
  CAST(total AS INTEGER) AS "{total}", CAST(total AS DOUBLE) / NULLIF(people, 0) * 100000 AS "Casos por 100 mil hab." FROM running
  WHERE total > 0 AND state <> 'NOT REPORTED')"""


def register_line(p: str, kits: Sequence[str], start: str | None, label: str) -> str:
    since = f" AND {W} >= DATE '{start}'" if start else ""
    return f"""
g AS (SELECT {W}, pathogen, {metrics()} FROM up WHERE {p}_test_result IN ('Pos', 'Neg') AND test_kit IN {in_list(kits)}{since} GROUP BY ALL),
h AS (SELECT {W}, pathogen, {metrics()} FROM reg_up WHERE {p}_test_result IN ('Pos', 'Neg'){since} GROUP BY ALL),
a AS (SELECT {W}, {max_rate(p, 'r')} FROM g GROUP BY {W}), b AS (SELECT {W}, {sum_pos(p, 'n')} FROM h GROUP BY {W}),
t AS (SELECT COALESCE(a.{W}, b.{W}) AS "Semanas epidemiológicas", a.r AS "Positividade (%, Lab. parceiros)", b.n AS "Infecções graves por {label} (SIVEP)"
  FROM a FULL OUTER JOIN b ON a.{W} = b.{W})"""


def register_regions(p: str, kits: Sequence[str], by_state: bool = False) -> str:
    labs = f"{p}_test_result IN ('Pos', 'Neg') AND test_kit IN {in_list(kits)} AND {W} >= DATE '2022-03-01'"
    reg = f"{p}_test_result IN ('Pos', 'Neg') AND {W} >= DATE '2022-03-01'"
    week = "COALESCE(sp.w, svp.w, stp.w)"
    sums = [f"CAST(SUM(CASE WHEN svp.region = '{r}' THEN svp.n ELSE 0 END) AS BIGINT) AS \"{r} (SRAG)\"" for r in REGIONS]
    if by_state:
        names = sorted(vocab.STATE_NAMES[c] for c in tb.STATE_CODES[:25])
        sums += [f"CAST(SUM(CASE WHEN svp.state = '{s}' THEN svp.n ELSE 0 END) AS BIGINT) AS \"{s} (SRAG)\"" for s in names]
    rates = ", ".join(f"MAX(CASE WHEN sp.region = '{r}' THEN sp.r END) AS \"{r} (Positividade)\"" for r in REGIONS)
    extra = ", state" if by_state else ""
    return f"""
g AS (SELECT {W}, region, pathogen, {metrics()} FROM up WHERE {labs} GROUP BY ALL),
h AS (SELECT {W}, region{extra}, pathogen, {metrics()} FROM reg_up WHERE {reg} GROUP BY ALL),
n AS (SELECT {W}, pathogen, {metrics()} FROM up WHERE {labs} GROUP BY ALL),
stp AS (SELECT {W} AS w, {max_rate(p, 'r')} FROM n GROUP BY {W}), sp AS (SELECT {W} AS w, region, {max_rate(p, 'r')} FROM g GROUP BY {W}, region),
svp AS (SELECT {W} AS w, region{extra}, {sum_pos(p, 'n')} FROM h GROUP BY {W}, region{extra}),
t AS (SELECT {week} AS "Semanas epidemiológicas", MAX(stp.r) AS "Brasil (Positividade)", {rates}, {', '.join(sums)}
  FROM sp FULL OUTER JOIN svp ON sp.w = svp.w AND sp.region = svp.region LEFT JOIN stp ON sp.w = stp.w GROUP BY {week})"""


ALL_COUNTS = "t AS (SELECT lab_id, test_kit, pathogen, result, COUNT(*) AS count FROM up WHERE result <> 'NT' GROUP BY ALL)"
STATE_RATES = (
    f"{grouped(W + ', state_code', 'TRUE')}, t AS (SELECT {W} AS semanas_epidemiologicas, state_code AS \"UF\", {max_rate('SC2', 'percentual')} "
    f"FROM g GROUP BY {W}, state_code HAVING MAX(CASE WHEN pathogen = 'SC2' THEN posrate END) IS NOT NULL)"
)

_C = [(c, c) for c in ("location_ibge_code", "location", "state", "lat", "long")]
_C16 = [("location_ibge_code", "Location_ibge_code"), ("location", "Location"), ("state_code", "State_code"), ("state", "State"), ("lat", "Lat"), ("long", "Long")]
_C25 = [(c, c) for c in ("location_ibge_code", "location", "state", "state_code", "lat", "long")]
_PLAIN = ("semanas epidemiologicas", ("state_code", "state"), "Casos da semana", "Casos acumulados")
_CITY = ("semanas epidemiologicas", "Casos da semana", "Casos acumulados")
_AGE_KEYS = {W: "semana_epidemiológica", "age_group": "faixas_etárias"}
_WK = {W: "semana epidemiológica"}
_S = "Semanas epidemiológicas"

BODIES: dict[str, str] = {
    "matrix_01_VRISP_line_posrate_direct_week_country_h": lines(FOUR, R01),
    "matrix_02_Resp_bar_pos_panel4_week_country_h": bars(FOUR, f"{R4} AND {W} >= DATE '2022-02-26'", _WK),
    "matrix_03_SC2_heat_posrate_week_state": STATE_HEAT,
    "matrix_04_SC2_heat_posrate_agegroups_week_country_h": heat("SC2", SC2, "Taxa de positividade"),
    "matrix_05_FLUA_heat_posrate_agegroups_week_country_h": heat("FLUA", FLU, "Positividade"),
    "matrix_06_Resp_line_posrate_direct_week_country_h": lines(["COVS", "ADENO", "BOCA", "RINO", "PARA", "ENTERO", "META", "BAC"], R06),
    "matrix_07_Resp_bar_pos_panel20PLUS_week_country_h": bars(PYR, "test_kit IN ('test_21', 'test_24')", _WK),
    "matrix_08_Resp_line_bar_posrate_posneg_week_country_h": OVERALL,
    "matrix_09_Resp_pyr_pos_agegroups_all_week_country_h": bars(PYR, R09, _AGE_KEYS),
    "matrix_10_Resp_pyr_pos_agegroups_panel4_week_country_h": bars(
        FOUR, f"{W} >= DATE '2022-01-01' AND age_group <> 'NOT REPORTED' AND {R4}", _AGE_KEYS
    ),
    "matrix_13_SC2_map_pos_direct_cities_h": city_map("SC2", "2025-06-14", SC2, _C, False, *_CITY),
    "matrix_13_SC2_map_pos_direct_states_h": state_map("SC2", "2025-06-14", SC2, False, *_PLAIN),
    "matrix_14_FLUB_map_pos_direct_cities_h": city_map("FLUB", "2025-09-13", FLU, _C, False, *_CITY),
    "matrix_14_FLUB_map_pos_direct_states_h": state_map("FLUB", "2025-09-13", FLU, False, *_PLAIN),
    "matrix_15_FLUB_heat_posrate_agegroups_week_country_h": heat("FLUB", FLU, "Positividade"),
    "matrix_16_VSR_map_pos_direct_cities_h": city_map(
        "VSR", "2025-12-21", VSR, _C16, True, "Semanas epidemiologicas", "Casos na última semana", "Casos cumulativos"
    ),
    "matrix_16_VSR_map_pos_direct_states_h": state_map(
        "VSR", "2025-12-21", VSR, True, _S, ("State_code", "State"), "Casos na última semana", "Casos cumulativos", True
    ),
    "matrix_17_SC2_line_posrate_bar_pos_direct_week_country_sivep": register_line("SC2", vocab.SC2_REGISTER_KITS, "2022-03-01", "SARS-CoV-2"),
    "matrix_18_VSR_line_posrate_bar_pos_direct_week_country_sivep": register_line("VSR", VSR, None, "VSR"),
    "matrix_19_FLUA_line_posrate_bar_pos_direct_week_country_sivep": register_line("FLUA", FLU, None, "Influenza A"),
    "matrix_20_FLUB_line_posrate_bar_pos_direct_week_country_sivep": register_line("FLUB", FLU, None, "Influenza B"),
    "matrix_21_SC2_line_posrate_direct_week_country_annual": annual("SC2", SC2),
    "matrix_22_VSR_line_posrate_direct_week_country_annual": annual("VSR", VSR),
    "matrix_23_FLUA_line_posrate_direct_week_country_annual": annual("FLUA", FLU),
    "matrix_24_FLUB_line_posrate_direct_week_country_annual": annual("FLUB", FLU),
    "matrix_25_FLUA_map_pos_direct_cities_h": city_map("FLUA", "2025-08-10", FLU, _C25, True, *_CITY),
    "matrix_25_FLUA_map_pos_direct_states_h": state_map("FLUA", "2025-08-10", FLU, True, *_PLAIN),
    "matrix_30_Resp_bar_total_posneg_months_regions": volume("month", "Ano-Mês", "'2022-01'"),
    "matrix_30_Resp_bar_total_posneg_week_regions": volume(W, "Semana Epidemiológica", "DATE '2022-01-01'"),
    "matrix_31_Resp_pyr_pos_agegroups_all_quarter_country": QUARTERS,
    "matrix_34_SC2_line_posrate_bar_pos_direct_week_regions_sivep": register_regions("SC2", vocab.SC2_REGISTER_KITS, True),
    "matrix_35_FLUA_line_posrate_bar_pos_direct_week_regions_sivep": register_regions("FLUA", FLU),
    "matrix_36_FLUB_line_posrate_bar_pos_direct_week_regions_sivep": register_regions("FLUB", FLU),
    "matrix_37_VSR_line_posrate_bar_pos_direct_week_regions_sivep": register_regions("VSR", VSR),
    "matrix_101_VRISP_posrate_posneg_week_region": flat({W: _S, "region": "Região"}),
    "matrix_102_VRISP_posrate_posneg_week_state": flat({W: _S, "region": "Região", "state": "Estado", "state_code": "Código do Estado"}),
    "matrix_ALL_count_by_labid_testkit_pathogen_result": ALL_COUNTS,
    "matrix_SC2_posrate_by_epiweek_state": STATE_RATES,
}

# variants: parent, day column, condition on it
_VARIANTS: dict[str, tuple[str, str]] = {}
for _n, _col, _days in [
    ("01_VRISP_line_posrate_direct_week_country", "semana epidemiológica", 364), ("02_Resp_bar_pos_panel4_week_country", "semana epidemiológica", 364),
    ("04_SC2_heat_posrate_agegroups_week_country", "Semana epidemiológica", 364), ("05_FLUA_heat_posrate_agegroups_week_country", "Semana epidemiológica", 364),
    ("06_Resp_line_posrate_direct_week_country", "semana epidemiológica", 364), ("07_Resp_bar_pos_panel20PLUS_week_country", "semana epidemiológica", 364),
    ("08_Resp_line_bar_posrate_posneg_week_country", "semanas_epidemiologicas", 364), ("09_Resp_pyr_pos_agegroups_all_week_country", "semana_epidemiológica", 56),
    ("10_Resp_pyr_pos_agegroups_panel4_week_country", "semana_epidemiológica", 56), ("15_FLUB_heat_posrate_agegroups_week_country", "Semana epidemiológica", 364),
]:
    _VARIANTS[f"matrix_{_n}_r"] = (f"matrix_{_n}_h", f'"{_col}" > (SELECT MAX("{_col}") FROM t) - {_days}')
for _n, _col in [
    ("13_SC2_map_pos_direct_cities", _PLAIN[0]), ("13_SC2_map_pos_direct_states", _PLAIN[0]), ("14_FLUB_map_pos_direct_cities", _PLAIN[0]),
    ("14_FLUB_map_pos_direct_states", _PLAIN[0]), ("16_VSR_map_pos_direct_cities", "Semanas epidemiologicas"), ("16_VSR_map_pos_direct_states", _S),
    ("25_FLUA_map_pos_direct_cities", _PLAIN[0]), ("25_FLUA_map_pos_direct_states", _PLAIN[0]),
]:
    _VARIANTS[f"matrix_{_n}_r"] = (f"matrix_{_n}_h", f'"{_col}" >= (SELECT MAX("{_col}") FROM t)')
_VARIANTS["matrix_01_VRISP_line_posrate_direct_week_country_c"] = (
    "matrix_01_VRISP_line_posrate_direct_week_country_h", '"semana epidemiológica" > (SELECT MAX("semana epidemiológica") FROM t) - 70'
)
_VARIANTS["matrix_03_SC2_heat_posrate_week_state_h"] = (
    "matrix_03_SC2_heat_posrate_week_state", "\"Completude final\" IN ('Apenas histórico', 'Alta qualidade')"
)
_VARIANTS["matrix_03_SC2_heat_posrate_week_state_r"] = (
    "matrix_03_SC2_heat_posrate_week_state",
    "\"Completude final\" IN ('Apenas 12 meses', 'Alta qualidade') AND semanas_epidemiologicas > (SELECT MAX(semanas_epidemiologicas) FROM t) - 364",
)


def sql() -> dict[str, str]:
    out = {}
    for name, body in BODIES.items():
        base = UNPIVOTED_BOTH if "reg_up" in body else UNPIVOTED
        out[name] = f"WITH {base}, {body} SELECT * FROM t"
    for name, (parent, where) in _VARIANTS.items():
        base = UNPIVOTED_BOTH if "reg_up" in BODIES[parent] else UNPIVOTED
        out[name] = f"WITH {base}, {BODIES[parent]} SELECT * FROM t WHERE {where}"
    return out


def together(of: str) -> str:
    """``of`` over every table, with ``{name}`` for its name and ``t`` for its rows, from samples unpivoted once."""
    base = UNPIVOTED_BOTH.replace(" up AS (", " up AS MATERIALIZED (").replace("reg_up AS (", "reg_up AS MATERIALIZED (")
    bodies = {name: (body, "TRUE") for name, body in BODIES.items()} | {name: (BODIES[parent], where) for name, (parent, where) in _VARIANTS.items()}
    parts = [f"SELECT * FROM (WITH {body}, chosen AS MATERIALIZED (SELECT * FROM t WHERE {where}) {of.replace('{name}', name)})" for name, (body, where) in bodies.items()]
    return f"WITH {base} " + " UNION ALL ".join(parts)
