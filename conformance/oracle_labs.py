"""Checking SQL of the laboratories, the register and the archive."""

from __future__ import annotations

from conformance import testbed as tb
from conformance.oracle_base import (
    NOW_LOCAL, REGISTER, REGISTER_CARRIED, REGISTER_LONG, case_map, filled, hot_columns, in_list, norm, state_case, tie_break,
)
from labwatch import labs_vocab as lv
from labwatch import vocab
from labwatch.vocab import PATHOGENS, RESULT_COLUMNS

CARRIED = ["test_id", "test_kit", "sex", "age", "location", "state", "date_testing", "patient_id", "file_name"]
_PREFIX_SEX = "CASE WHEN {s} ILIKE 'F%' THEN 'F' WHEN {s} ILIKE 'M%' THEN 'M' END"
_CLAMP = "CASE WHEN {a} > 120 OR {a} < 0 THEN NULL ELSE {a} END"


def day(c: str, fmt: str) -> str:
    return f"CAST(try_strptime({c}, '{fmt}') AS DATE)"


def three(r: str, lo: float, hi: float) -> str:
    v = f"TRY_CAST({r} AS DOUBLE)"
    return f"CASE WHEN regexp_matches({r}, '^[0-9]') THEN CASE WHEN {v} <= {lo} THEN 0 WHEN {v} <= {hi} THEN -3 WHEN {v} > {hi} THEN 1 END ELSE -2 END"


def two(r: str, t: float) -> str:
    v = f"TRY_CAST({r} AS DOUBLE)"
    return f"CASE WHEN regexp_matches({r}, '^[0-9]') THEN CASE WHEN {v} < {t} THEN 0 WHEN {v} >= {t} THEN 1 END ELSE -2 END"


def age_text(c: str, otherwise: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^[0-9]*$') THEN TRY_CAST({c} AS INTEGER) WHEN regexp_matches({c}, '^[0-9]*A') THEN TRY_CAST(split_part({c}, 'A', 1) AS INTEGER) "
        f"WHEN regexp_matches({c}, '^[0-9]*M') THEN 0 WHEN regexp_matches({c}, '^[0-9]*D') THEN 0 WHEN {c} IS NULL THEN NULL ELSE {otherwise} END"
    )


def years(a: str, b: str) -> str:
    return f"CAST(date_part('year', age(CAST({a} AS TIMESTAMP), CAST({b} AS TIMESTAMP))) AS INTEGER)"


_BARE = "replace(replace(result, 'INFERIOR A ', ''), 'SUPERIOR A ', '')"
_DB_RESULT = (
    f"CASE WHEN codigo IN {in_list(lv.DBMOL_WORD_CODES)} THEN CASE WHEN result IN {in_list(lv.DBMOL_NEGATIVE_WORDS)} OR result ILIKE 'INFERIOR A%' THEN 0 "
    f"WHEN result IN {in_list(lv.DBMOL_POSITIVE_WORDS)} OR result ILIKE 'DETECTADO %' THEN 1 ELSE -2 END "
    f"WHEN codigo = 'ADENO' THEN {three(_BARE, 8.0, 10.0)} WHEN codigo = 'INFAG' AND result ILIKE 'INFERIOR A%' THEN 0 "
    f"WHEN codigo = 'INFAG' THEN {three('result', 0.8, 1.1)} WHEN codigo IN ('COVI19Q', 'NEUCOV') THEN {two(_BARE, 30.0)} "
    f"WHEN codigo = 'COV19A' THEN {three(_BARE, 0.8, 1.09)} WHEN codigo IN ('MYPNG', 'MYPNM') THEN {two(_BARE, 10.0)} ELSE -2 END"
)

LONG: dict[str, str] = {}

LONG["DBMOL"] = f"""
typed AS (SELECT CAST(CAST(NumeroPedido AS BIGINT) AS VARCHAR) AS test_id, Sexo AS s, {norm('Procedimento')} AS exame, {norm('CodigoProcedimento')} AS codigo,
  {norm('Parametro')} AS detalhe_exame, CAST(DataCadastro AS DATE) AS date_testing, CAST(DataNascimento AS DATE) AS born, {norm('Cidade')} AS location,
  {norm('UF')} AS uf, {norm('Resultado')} AS result, file_name FROM raw),
long_ AS (SELECT md5(concat(test_id, exame, CASE WHEN codigo IN {in_list(lv.DBMOL_PANEL_CODES)} THEN codigo ELSE detalhe_exame END)) AS sample_id, test_id, date_testing,
  CASE WHEN {years('date_testing', 'born')} > 120 THEN NULL ELSE {years('date_testing', 'born')} END AS age, {case_map('exame', lv.DBMOL_KITS, "'UNKNOWN'")} AS test_kit,
  detalhe_exame, {_DB_RESULT} AS result, CASE s WHEN 'F' THEN 'F' WHEN 'M' THEN 'M' END AS sex, location, {state_case('uf')} AS state,
  CAST(NULL AS VARCHAR) AS patient_id, file_name FROM typed WHERE codigo IN {in_list(lv.DBMOL_KEPT_CODES)}
  AND detalhe_exame NOT IN {in_list(lv.DBMOL_DROPPED_PARAMETERS)} AND detalhe_exame IS NOT NULL AND result NOT IN {in_list(lv.DBMOL_DROPPED_RESULTS)}),
hot AS (SELECT * EXCLUDE (result), {hot_columns(lv.DBMOL_ANALYTES, 'detalhe_exame')} FROM long_ WHERE result != -3)"""

_PANELS = " ".join(f"WHEN exame = '{p}' THEN '{p}'" for p in lv.EINSTEIN_PANELS)
_PANEL_PREFIXES = " ".join(f"WHEN exame ILIKE '{p}%' THEN '{v}'" for p, v in lv.EINSTEIN_PANEL_PREFIXES.items())
_KIT_PREFIX = "CASE WHEN exame ILIKE 'PAINEL MOLECULAR PATOGENOS RESPIRATORIOS%' THEN 'test_4' ELSE 'UNKNOWN' END"
LONG["EINSTEIN"] = f"""
typed AS (SELECT DISTINCT accession AS test_id, sexo AS s, TRY_CAST(idade AS INTEGER) AS a, {norm('exame')} AS exame, {norm('detalhe_exame')} AS detalhe,
  {day('dh_coleta', '%d/%m/%Y')} AS date_testing, {norm('municipio')} AS location, {norm('estado')} AS state, patogeno, {norm('resultado')} AS r, file_name FROM raw),
mapped AS (SELECT md5(concat(test_id, exame, CASE {_PANELS} {_PANEL_PREFIXES} ELSE detalhe END)) AS sample_id, test_id, {_PREFIX_SEX.format(s='s')} AS sex,
  {_CLAMP.format(a='a')} AS age, exame, regexp_replace(regexp_replace(detalhe, '[.:]', '', 'g'), '\\s+', ' ', 'g') AS detalhe_exame, date_testing, location, state,
  CASE r WHEN 'DETECTADO' THEN 1 WHEN 'NAO DETECTADO' THEN 0 END AS result, {case_map('exame', lv.EINSTEIN_KITS, _KIT_PREFIX)} AS test_kit,
  CAST(NULL AS VARCHAR) AS patient_id, file_name FROM typed),
bad AS (SELECT * FROM mapped WHERE CAST(regexp_extract(CAST(date_testing AS VARCHAR), '[0-9]{{4}}') AS INTEGER) < 2023 AND age = 182),
long_ AS (SELECT * FROM mapped WHERE sample_id NOT IN (SELECT sample_id FROM bad) AND NOT (date_testing = DATE '2024-05-10' AND age = 124)
  AND NOT (exame ILIKE 'ZZ%') AND date_testing >= DATE '2025-08-01'),
hot AS (SELECT * EXCLUDE (result), {hot_columns(lv.EINSTEIN_ANALYTES, 'detalhe_exame')} FROM long_)"""

_A = " ".join(f"WHEN '{k}' THEN '{a}'" for k, (a, _) in lv.FLEURY_RAPID_RESULTS.items())
_B = " ".join(f"WHEN '{k}' THEN '{b}'" for k, (_, b) in lv.FLEURY_RAPID_RESULTS.items())
_FAB = "exame = 'AGINFLU' AND pathogen = 'INFLUENZA A E B - TESTE RAPIDO' AND result NOT IN ('INCONCLUSIVO')"
LONG["FLEURY"] = f"""
typed AS (SELECT "CODIGO REQUISICAO" AS test_id, {day('"DATA COLETA"', '%d/%m/%Y')} AS date_testing, PACIENTE AS patient_id, SEXO AS sex, IDADE AS a,
  {norm('MUNICIPIO')} AS location, {norm('ESTADO')} AS uf, {norm('EXAME')} AS exame, {norm('PATOGENO')} AS pathogen, {norm('RESULTADO')} AS result, file_name
  FROM raw WHERE EXAME IS NOT NULL),
mapped AS (SELECT md5(concat(test_id, exame)) AS sample_id, test_id, date_testing, patient_id, sex, {age_text('a', '-1')} AS age, location, {state_case('uf')} AS state,
  exame, {case_map('exame', lv.FLEURY_KITS, "'UNKNOWN'")} AS test_kit, file_name, pathogen, result FROM typed WHERE exame NOT IN {in_list(lv.FLEURY_DROPPED_EXAMS)}
  AND test_id NOT IN {in_list(lv.FLEURY_DROPPED_TESTS)} AND result NOT IN {in_list(lv.FLEURY_DROPPED_RESULTS)} AND pathogen NOT IN {in_list(lv.FLEURY_DROPPED_PATHOGENS)}),
split AS (SELECT * FROM mapped WHERE pathogen != 'INFLUENZA A E B - TESTE RAPIDO'
  UNION SELECT * EXCLUDE (pathogen, result), '{lv.FLEURY_RAPID_A}', CASE result {_A} ELSE 'UNKNOWN' END FROM mapped WHERE {_FAB}
  UNION SELECT * EXCLUDE (pathogen, result), '{lv.FLEURY_RAPID_B}', CASE result {_B} ELSE 'UNKNOWN' END FROM mapped WHERE {_FAB}),
long_ AS (SELECT * EXCLUDE (result), {case_map('result', lv.FLEURY_RESULTS, '-2')} AS result FROM split),
hot AS (SELECT * EXCLUDE (result), {hot_columns(lv.FLEURY_ANALYTES, 'pathogen')} FROM long_)"""

_HILAB_TYPED = ["test_id", "state_code", "location", "date_testing", "exame", "result", "age", "patient_id", "sex", "file_name"]
LONG["HILAB"] = f"""
typed AS (SELECT "Código Da Cápsula" AS test_id, {norm('Estado')} AS state_code, {norm('Cidade')} AS location, {day('"Data Do Exame"', '%d/%m/%Y')} AS date_testing,
  {norm('Exame')} AS exame, {norm('Resultado')} AS result, TRY_CAST(Idade AS INTEGER) AS age, Paciente AS patient_id, {norm('Sexo')} AS sex, file_name FROM raw
  WHERE Exame NOT IN {in_list(lv.HILAB_DROPPED_EXAMS)} AND Resultado NOT IN {in_list(lv.HILAB_DROPPED_RESULTS)}),
single AS (SELECT *, md5(concat(test_id, exame, patient_id)) AS sample_id,
  ROW_NUMBER() OVER (PARTITION BY md5(concat(test_id, exame, patient_id)) ORDER BY {tie_break(_HILAB_TYPED)}) AS rn FROM typed),
long_ AS (SELECT sample_id, test_id, location, date_testing, exame, {case_map('exame', lv.HILAB_KITS, "'UNKNOWN'")} AS test_kit, {case_map('result', lv.HILAB_RESULTS, '-2')} AS result,
  {state_case('state_code')} AS state, {_CLAMP.format(a='age')} AS age, patient_id, {_PREFIX_SEX.format(s='sex')} AS sex, file_name FROM single WHERE rn = 1),
hot AS (SELECT * EXCLUDE (result), {hot_columns(lv.HILAB_ANALYTES, 'exame')} FROM long_)"""

_HL = lv.HLAGYN_COLUMNS
_HL_CODE = ", ".join(
    f"CASE WHEN {c} ILIKE 'NAO DETECTADO%' THEN 0 WHEN {c} ILIKE 'DETECTADO%' THEN 1 WHEN {c} ILIKE 'INCONCLUSIVO' THEN -1 WHEN {c} IS NULL THEN -1 ELSE -2 END AS {c}"
    for c in _HL.values()
)
_HL_ANY = " OR ".join(f"({c} NOT IN ('INCONCLUSIVO') AND {c} IS NOT NULL)" for c in _HL.values())
_HL_GROUPS = ", ".join(f"greatest({', '.join(_HL[h] for h in lv.HLAGYN_RESULTS[p])}) AS {p}_test_result" for p in PATHOGENS)
LONG["HLAGYN"] = f"""
typed AS (SELECT Pedido AS test_id, CAST("Data Coleta" AS DATE) AS date_testing, TRY_CAST(Idade AS INTEGER) AS a, {norm('Sexo')} AS s, {norm('"Métodologia"')} AS detalhe_exame,
  {norm('Cidade')} AS location, {norm('UF')} AS uf, {', '.join(f'{norm(chr(34) + h + chr(34))} AS {c}' for h, c in _HL.items())}, file_name FROM raw),
long_ AS (SELECT md5(concat(test_id, detalhe_exame)) AS sample_id, test_id, date_testing, {_CLAMP.format(a='a')} AS age, {_PREFIX_SEX.format(s='s')} AS sex, location,
  {state_case('uf')} AS state, CASE WHEN {_HL['Resultado']} IS NOT NULL THEN 'covid_pcr' WHEN {_HL['Vírus Influenza A']} IS NOT NULL THEN 'test_4'
  WHEN {_HL['VIRUS_IA']} IS NOT NULL THEN 'test_24' ELSE 'UNKNOWN' END AS test_kit, CAST(NULL AS VARCHAR) AS patient_id, file_name, {_HL_CODE} FROM typed WHERE {_HL_ANY}),
hot AS (SELECT sample_id, {', '.join(CARRIED)}, {_HL_GROUPS} FROM long_)"""

LONG["HPARDINI"] = f"""
typed AS (SELECT CODIGO AS test_id, CAST(DATACOLETA AS DATE) AS date_testing, {norm('"PATÓGENO"')} AS pathogen, {norm('"MÉTODO"')} AS detalhe_exame, {norm('CIDADE')} AS location,
  {norm('UF')} AS uf, SEXO AS s, TRY_CAST(IDADE AS BIGINT) AS a, {norm('RESULTADO')} AS r, file_name FROM raw),
long_ AS (SELECT md5(test_id) AS sample_id, test_id, {_PREFIX_SEX.format(s='s')} AS sex, CAST({_CLAMP.format(a='a')} AS INTEGER) AS age, date_testing, location, {state_case('uf')} AS state,
  pathogen, CASE r WHEN 'POSITIVO' THEN 1 WHEN 'NEGATIVO' THEN 0 END AS result,
  CASE WHEN pathogen = 'SARS-COV-2' AND detalhe_exame = 'PCR EM TEMPO REAL' THEN 'covid_pcr' ELSE 'UNKNOWN' END AS test_kit, CAST(NULL AS VARCHAR) AS patient_id, file_name
  FROM typed WHERE pathogen NOT IN {in_list(lv.HPARDINI_DROPPED_PATHOGENS)}),
hot AS (SELECT * EXCLUDE (result), {hot_columns(lv.HPARDINI_ANALYTES, 'pathogen')} FROM long_)"""

_SABIN_PANEL = " ".join(f"WHEN exame ILIKE '{p}%' THEN '{k}'" for p, k in lv.SABIN_PANEL_PREFIXES.items())
_SABIN_KITS = [("covid_pcr", lv.SABIN_SINGLE_PCR), ("covid_antigen", lv.SABIN_ANTIGEN), ("test_21", lv.SABIN_TEST_21), ("test_24", lv.SABIN_TEST_24), ("test_4", lv.SABIN_TEST_4)]
_SABIN_KEPT = [p for _, names in _SABIN_KITS for p in names]
LONG["SABIN"] = f"""
typed AS (SELECT OS AS test_id, {norm('Estado')} AS state, {norm('Municipio')} AS location, {day('DataAtendimento', '%m/%d/%Y')} AS date_testing, {day('DataNascimento', '%m/%d/%Y')} AS born,
  Sexo AS s, Descricao AS exame, Parametro AS detalhe_exame, strip_accents(upper(trim(Resultado))) AS r, file_name FROM raw),
long_ AS (SELECT md5(concat(test_id, exame, CASE WHEN detalhe_exame IN ('RDRPALVO', 'NALVO') THEN 'NALVO_RDRPALVO' {_SABIN_PANEL} ELSE detalhe_exame END)) AS sample_id, test_id, state,
  location, date_testing, {_PREFIX_SEX.format(s='s')} AS sex, {years('date_testing', 'born')} AS age, detalhe_exame,
  CASE WHEN r ILIKE 'NAO DETECTAD%' THEN 0 WHEN r ILIKE 'DETECTAD%' THEN 1 WHEN r IN {in_list(lv.SABIN_POSITIVE_NAMES)} THEN 1 WHEN r = '0' THEN 0
    WHEN r ILIKE 'NAO REAGENTE%' THEN 0 WHEN r ILIKE 'REAGENTE%' THEN 1 ELSE -2 END AS result,
  CASE {' '.join(f'WHEN detalhe_exame IN {in_list(n)} THEN {chr(39)}{k}{chr(39)}' for k, n in _SABIN_KITS)} ELSE 'UNKNOWN' END AS test_kit,
  CAST(NULL AS VARCHAR) AS patient_id, file_name FROM typed WHERE detalhe_exame IN {in_list(_SABIN_KEPT)}),
hot AS (SELECT * EXCLUDE (result), {hot_columns(lv.SABIN_ANALYTES, 'detalhe_exame')} FROM long_)"""

LONG["TARGET"] = f"""
typed AS (SELECT CAST(CAST("Numerdo do Pedido" AS BIGINT) AS VARCHAR) AS test_id, {day('"Data de Coleta"', '%d/%m/%Y')} AS date_testing, Sexo AS s, {norm('Idade')} AS a,
  {norm('"Município"')} AS location, {norm('Estado')} AS uf, {norm('Exame')} AS exame, "Cód. Pátógeno" AS detalhe_exame, {norm('Resultado')} AS r, file_name FROM raw
  WHERE CAST(CAST("Numerdo do Pedido" AS BIGINT) AS VARCHAR) NOT IN {in_list(lv.TARGET_DROPPED_TESTS)}),
long_ AS (SELECT md5(concat(test_id, exame)) AS sample_id, test_id, date_testing, CASE s WHEN 'F' THEN 'F' WHEN 'M' THEN 'M' END AS sex, {age_text('a', 'NULL')} AS age, location,
  {state_case('uf')} AS state, detalhe_exame, {case_map('exame', lv.TARGET_KITS)} AS test_kit,
  CASE WHEN r = 'NAO DETECTADO' THEN 0 WHEN r = 'DETECTADO' THEN 1 WHEN r ILIKE 'DETECTADO (PRESENCA DO RNA DE CORONAVIRUS SARS-COV-2%' THEN 1 END AS result,
  CAST(NULL AS VARCHAR) AS patient_id, file_name FROM typed WHERE exame NOT IN {in_list(lv.TARGET_DROPPED_EXAMS)} AND r NOT IN {in_list(lv.TARGET_DROPPED_RESULTS)}),
hot AS (SELECT * EXCLUDE (result), {hot_columns(lv.TARGET_ANALYTES, 'detalhe_exame')} FROM long_)"""


def lab_sql(lab_id: str) -> str:
    raw = f"raw AS ({tb.duck(tb.RAW[lab_id])})"
    count = lab_id not in ("HILAB", "HLAGYN")
    return f"WITH {tb.DUCK_TESTS}, {raw}, {LONG[lab_id]}, {filled('hot', CARRIED, count)} SELECT * FROM samples"


_ARCHIVE_KEPT = ["lab_id", "test_id", "test_kit", "date_testing", "state_code", "patient_id", "sex", "age", *RESULT_COLUMNS, "location", "state"]
ARCHIVE = f"""
{tb.DUCK_CASES}, raw_archive AS ({tb.duck(tb.ARCHIVE)}),
archive_fixed AS (SELECT 'HISTORICAL_' || sample_id AS sample_id, CASE lab_id WHEN 'DB Mol' THEN 'DBMOL' WHEN 'HLAGyn' THEN 'HLAGYN' ELSE lab_id END AS lab_id, test_id, test_kit,
  CAST(date_testing AS DATE) AS date_testing, state_code, patient_id, CASE WHEN NOT sex IN ('M', 'F') THEN NULL ELSE sex END AS sex,
  CASE WHEN CAST(round(CAST(age AS DECIMAL(18, 4))) AS INTEGER) < 0 THEN NULL ELSE CAST(round(CAST(age AS DECIMAL(18, 4))) AS INTEGER) END AS age,
  {', '.join(RESULT_COLUMNS)}, {norm('location')} AS location, {norm('state')} AS state FROM raw_archive
  WHERE NOT ({' AND '.join(f"{c} = 'NT'" for c in RESULT_COLUMNS)}) AND NOT SC2_test_result = 'Inconclusivo'),
archive_single AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY {tie_break(_ARCHIVE_KEPT, ('date_testing',))}) AS rn FROM archive_fixed),
archive_final AS (SELECT * EXCLUDE (rn), CAST(1 AS BIGINT) AS qty_original_lines, {NOW_LOCAL} AS created_at, {NOW_LOCAL} AS updated_at,
  'COMBINED_HISTORICAL_DATA' AS file_name FROM archive_single WHERE rn = 1)"""


def sql() -> dict[str, str]:
    out = {f"lab_{lab.lower()}": lab_sql(lab) for lab in LONG}
    out["register_samples"] = f"WITH {REGISTER} SELECT * FROM register_"
    out["archive_samples"] = f"WITH {ARCHIVE} SELECT * FROM archive_final"
    return out
