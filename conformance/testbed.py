"""Surveillance-shaped inputs derived from the driver's tables.

The tables hold no laboratory data, so raw files, samples and dimensions are
derived from them row by row. The deriving SQL is plain enough to run on both
engines: ``spark_table`` runs it on Spark, ``duck`` renders it for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch import labs_vocab as lv
from labwatch import vocab
from labwatch.sinks.buckets import Storage

Derive = Callable[[str], str]  # changes deriving SQL before it runs

AS_OF = "2026-02-15"
NOW = "2026-02-15 12:00:00"
LAST_DAY = "2026-02-28"

# Stated so that reading a table does not first read its footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = list(SCHEMAS)

#: Bytes of line items, as they lie in their files, that one task joins.
PER_TASK = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def quote(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def pick(expr: str, values: Sequence[object], default: object = None) -> str:
    """The n-th value of a list counted from 0, n being a whole-number expression."""
    found = f"try_element_at(array({', '.join(quote(v) for v in values)}), CAST({expr} AS INT) + 1)"
    return found if default is None else f"coalesce({found}, {quote(default)})"


# Days from an order to the end of the order book. Both engines subtract days
# from a date; the difference of two dates is what they spell differently.
_AGE = {
    "spark": "datediff(DATE '2001-08-02', CAST(o_orderdate AS DATE))",
    "duck": "date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02')",
}

# Order dates spread over 1575 days before LAST_DAY, denser toward the end as in
# a network that grows. Older weeks are thinned to every fourth, sixth and
# eighth, so that weeks with few and with many tests occur in every period.
_BACK = "CAST(floor(CAST({age} AS DOUBLE) * {age} / 3672) AS INT)"
_DAY = (
    f"DATE '{LAST_DAY}' - CAST(CASE WHEN back < 42 THEN back WHEN back < 182 THEN back - back % 28 + back % 7 "
    "WHEN back < 364 THEN back - back % 42 + back % 7 ELSE back - back % 56 + back % 7 END AS INT)"
)
# One state takes the customers of two thirds of the keys besides its own.
_NATION = "CASE WHEN o_custkey % 3 <> 0 THEN 24 ELSE c_nationkey END AS c_nationkey"
# Queries about places keep the nations of two thirds: there it takes the customers of one third.
_NATION_OF_MOST = "CASE WHEN o_custkey % 3 = 1 THEN 24 ELSE c_nationkey END AS c_nationkey"

STATE_CODES = list(vocab.STATE_NAMES)
KITS = [
    "covid_pcr", "covid_pcr", "covid_pcr", "covid_pcr", "covid_pcr", "covid_antigen", "thermo", "test_4", "test_4", "test_4", "test_14", "test_21", "test_21", "test_21",
    "test_23", "test_24", "test_24", "test_24", "test_3", "flu_pcr", "flu_antigen", "vsr_antigen", "adeno_pcr",
    "bac_pcr", "sc2_antigen", "UNKNOWN",
]
ANALYTES = ["SC2"] * 8 + ["FLUA"] * 3 + ["FLUB"] * 3 + ["VSR"] * 2 + vocab.PATHOGENS[4:]

PLACE = (
    "CASE WHEN o_custkey % 40 = 5 THEN 'Moji das Cruzes' "
    "WHEN o_custkey % 8 = 7 THEN 'Desconhecida' "
    "WHEN o_custkey % 3 = 0 THEN concat('  Município ', CAST(c_nationkey AS STRING), '-', CAST(o_custkey % 8 AS STRING)) "
    "WHEN o_custkey % 3 = 1 THEN concat('MUNICIPIO ', CAST(c_nationkey AS STRING), '-', CAST(o_custkey % 8 AS STRING), ' ') "
    "ELSE concat('município ', CAST(c_nationkey AS STRING), '-', CAST(o_custkey % 8 AS STRING)) END"
)
STATE = (
    "CASE WHEN o_custkey % 40 = 5 THEN 'SP' WHEN o_custkey % 101 = 0 THEN 'Hospital' "
    f"WHEN o_custkey % 4 = 0 THEN {pick('c_nationkey', STATE_CODES)} "
    f"ELSE {pick('c_nationkey', [vocab.STATE_NAMES[c] for c in STATE_CODES])} END"
)
STATE_CODE = pick("c_nationkey", STATE_CODES)
SEX = pick("o_orderkey % 5", ["F", "M", "Feminino", "masculino", None])
AGE = "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(floor(p_size * 2.5) AS INT) - 4 END"


def dated_orders(engine: str) -> str:
    """Orders with their customer's segment and nation and a day ``dt``."""
    back = _BACK.format(age=_AGE[engine])
    return (
        f"(SELECT *, {_DAY} AS dt FROM (SELECT orders.*, {_NATION}, c_mktsegment, {back} AS back FROM {{orders}} AS orders "
        "JOIN {customer} AS customer ON o_custkey = c_custkey) AS aged)"
    )


def tests_sql(engine: str) -> str:
    """One row per line item with its dated order and its part's size."""
    return (
        f"SELECT lineitem.*, dated.*, p_size, p_brand FROM {{lineitem}} AS lineitem JOIN {dated_orders(engine)} AS dated "
        "ON l_orderkey = o_orderkey JOIN {part} AS part ON l_partkey = p_partkey"
    )


def cases_sql(engine: str) -> str:
    """One row per dated order."""
    return f"SELECT * FROM {dated_orders(engine)} AS dated"


# -- samples of a mixed laboratory -------------------------------------------

LONG = f"""
SELECT CAST(l_orderkey AS STRING) AS test_id, {pick(f"o_orderkey % {len(KITS)}", KITS)} AS test_kit,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'DBMOL' WHEN 'BUILDING' THEN 'FLEURY' WHEN 'FURNITURE' THEN 'SABIN'
    WHEN 'HOUSEHOLD' THEN 'HILAB' ELSE 'DASA' END AS lab_id,
  {pick("o_orderkey % 5", ["F", "M", "F", "M", None])} AS sex, {AGE} AS age, {PLACE} AS location, {STATE} AS state,
  dt AS date_testing, concat('P', CAST(o_custkey AS STRING)) AS patient_id,
  concat('file_', CAST(l_suppkey % 7 AS STRING), '.csv') AS file_name, {pick("l_partkey % 24", ANALYTES)} AS analyte,
  CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN -2 WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 0
    ELSE -1 END AS result
FROM {{tests}}"""

# -- geography ---------------------------------------------------------------

_CELLS = " UNION ALL ".join(f"SELECT n_nationkey AS nk, {j} AS j FROM {{nation}} AS n{j}" for j in range(7))
_REGION_NAMES = list(vocab.REGION_LABELS)

MUNICIPALITIES = f"""
SELECT CASE WHEN nk = 18 AND j = 0 THEN {vocab.RIO_DE_JANEIRO_CODE} ELSE 1000000 + nk * 100 + j END AS CD_MUN,
  nk + 11 AS CD_UF, {pick("nk", STATE_CODES)} AS SIGLA_UF,
  {pick("nk", [vocab.STATE_NAMES[c] for c in STATE_CODES])} AS NM_UF,
  {pick("nk", [vocab.STATE_NAMES[c] for c in STATE_CODES])} AS NM_UF_NORM,
  CASE WHEN nk = 24 AND j = 6 THEN 'Mogi das Cruzes' ELSE concat('Município ', CAST(nk AS STRING), '-', CAST(j AS STRING)) END AS NM_MUN,
  CASE WHEN nk = 24 AND j = 6 THEN 'MOGI DAS CRUZES' ELSE concat('MUNICIPIO ', CAST(nk AS STRING), '-', CAST(j AS STRING)) END AS NM_MUN_NORM,
  {pick("nk % 5", _REGION_NAMES)} AS REGIAO, CAST(0 - nk AS DOUBLE) - j / CAST(8 AS DOUBLE) AS lat,
  CAST(0 - 40 - nk AS DOUBLE) + j / CAST(16 AS DOUBLE) AS long
FROM ({_CELLS}) AS cells"""

MACROREGIONS = f"""
SELECT CD_UF AS CO_UF, concat('BR', CAST(CD_MUN AS STRING)) AS ADM2_PCODE, CD_UF * 10 + CD_MUN % 2 AS CO_MACSAUD,
  concat('Macro ', CAST(CD_UF AS STRING), '/', CAST(CD_MUN % 2 AS STRING)) AS DS_NOMEPAD_macsaud, SIGLA_UF AS DS_UF_SIGLA,
  CASE WHEN CD_MUN % 50 = 3 THEN 0 ELSE 10000 + CD_MUN % 100000 END AS Populacao, NM_UF AS state_name,
  CASE REGIAO {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.REGION_LABELS.items())} END AS region
FROM {{municipalities}}"""


# -- raw files, all text -----------------------------------------------------

_DAY_TEXT = "CAST(dt AS STRING)"
_Y, _M, _D = (f"substr({_DAY_TEXT}, {a}, {n})" for a, n in ((1, 4), (6, 2), (9, 2)))
_DMY = f"concat({_D}, '/', {_M}, '/', {_Y})"
_MDY = f"concat({_M}, '/', {_D}, '/', {_Y})"
_BIRTH = "CAST(dt - CAST(p_size * 900 + o_orderkey % 365 AS INT) AS STRING)"
_BIRTH_MDY = f"concat(substr({_BIRTH}, 6, 2), '/', substr({_BIRTH}, 9, 2), '/', substr({_BIRTH}, 1, 4))"
_ROW = "(l_orderkey + l_linenumber)"
_FILE = "concat('file_', CAST(l_suppkey % 7 AS STRING), '.csv') AS file_name"
_CITY = "concat(' São José ', CAST(o_custkey % 30 AS STRING), '\t')"
_AGE_TEXT = (
    "CASE o_orderkey % 6 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN concat(CAST(p_size AS STRING), 'A10M') "
    "WHEN 2 THEN concat(CAST(p_size % 12 AS STRING), 'M') WHEN 3 THEN concat(CAST(p_size % 30 AS STRING), 'D') "
    "WHEN 4 THEN NULL ELSE 'idoso' END"
)
_DB_CODES = ["PRESP", "RESP4", "ADENO", "INFAG", "COVI19Q", "NEUCOV", "COV19A", "MYPNG", "SARS", "MYPNE", "FLUAB"]
_DB_PARTS = ["INFLUA", "INFLUB", "SARSC", "SINCIA", "RINOV", "PARA1", "METODO", "BOCAV", "ENTERO", "MYCOP", "METAP", "CORNL"]
_NUMBER = "CAST(CAST(l_quantity AS INT) AS STRING)"

RAW = {
    "DBMOL": f"""
SELECT concat('00', CAST(l_orderkey AS STRING)) AS NumeroPedido, {pick("o_orderkey % 4", ["F", "M", "I"])} AS Sexo,
  {pick("o_orderkey % 5", ["Painel Respiratório - Plus (24 patógenos incluindo SARS COV-2)", " adenovírus", "Influenza A e B - Detecção por PCR", "Coronavírus 2019 - SARS-CoV-2 IGG Quantitativo", "Outro exame"])} AS Procedimento,
  {pick("o_orderkey % 11", _DB_CODES)} AS CodigoProcedimento,
  CASE WHEN o_orderkey % 11 IN (2, 3, 4, 5, 6, 7, 8) THEN {pick("o_orderkey % 11", _DB_CODES)} ELSE {pick(f"{_ROW} % 12", _DB_PARTS)} END AS Parametro,
  {_DAY_TEXT} AS DataCadastro, {_BIRTH} AS DataNascimento, {_CITY} AS Cidade, {STATE_CODE} AS UF,
  CASE WHEN o_orderkey % 11 IN (2, 3, 4, 5, 6, 7) THEN CASE l_linenumber % 4 WHEN 0 THEN {_NUMBER} WHEN 1 THEN concat('Inferior a ', {_NUMBER}, '.5')
      WHEN 2 THEN concat(CAST(l_linenumber % 2 AS STRING), '.', {_NUMBER}) ELSE concat('Superior a ', {_NUMBER}) END
    ELSE {pick("l_partkey % 7", ["Detectado", "Não detectado", "Não Detectado", "Negativo", "Positivo", "Inconclusivo", "Amostra insuficiente"])} END AS Resultado,
  {_FILE} FROM {{tests}}""",
    "EINSTEIN": f"""
SELECT CAST(l_orderkey AS STRING) AS accession, {SEX} AS sexo, CAST({AGE} AS STRING) AS idade,
  {pick("o_orderkey % 6", ["Painel Molecular Patógenos Respiratórios II", "PCR para Influenza A/B e VRS", "PCR em tempo real para detecção de coronavírus", "ZZ TESTE", "Pesquisa Rápida para Influenza A e B", "Exame novo"])} AS exame,
  {pick("l_partkey % 7", ["Influenza A:", "Influenza  B.", "Vírus Sincicial Respiratório", "SARS-CoV-2 Painel", "Resultado   COVID-19:", "Influenza A, Teste Rápido", "Outro"])} AS detalhe_exame,
  {_DMY} AS dh_coleta, {_CITY} AS municipio, {STATE} AS estado, 'X' AS patogeno,
  {pick("l_suppkey % 4", ["Detectado", "Não Detectado", "Não detectado", "Indeterminado"])} AS resultado, {_FILE} FROM {{tests}}""",
    "FLEURY": f"""
SELECT CAST(l_orderkey AS STRING) AS `CODIGO REQUISICAO`, {_DMY} AS `DATA COLETA`, concat('P', CAST(o_custkey AS STRING)) AS PACIENTE,
  {pick("o_orderkey % 3", ["F", "M", "X"])} AS SEXO, {_AGE_TEXT} AS IDADE, {_CITY} AS MUNICIPIO, {STATE_CODE} AS ESTADO,
  {pick("o_orderkey % 7", ["VIRUSMOL", "COVIDFLURSVGX", "AGINFLU", "FLUABRSVGX", "2019NCOV", "ZIKAVIGM", "NOVO"])} AS EXAME,
  CASE WHEN o_orderkey % 7 = 2 THEN {pick("l_linenumber % 3", ["Influenza A e B - Teste Rápido", "Influenza A e B - Teste Rápido - Kit", "Influenza A - Teste Rápido"])}
    ELSE {pick("l_partkey % 8", ["VirusMol, SARS-CoV-2", "VirusMol, Influenza A", "VirusMol, Influenza B", "VirusMol, Parainfluenza 1", "VirusMol, Adenovírus", "VirusMol, Mycoplasma pneumoniae", "COVIDFLURSVGX - Influenza A", None])} END AS PATOGENO,
  CASE WHEN o_orderkey % 7 = 2 THEN {pick("l_suppkey % 6", ["Negativo", "Influenza A - Positivo", "Influenza B - Positivo", "Influenza A e B - Positivo", "Inconclusivo", "Ilegível"])}
    ELSE {pick("l_suppkey % 6", ["Positivo", "Não detectado", "Detectado", "Indetectável", "Inconclusivo", "Ilegível"])} END AS RESULTADO,
  {_FILE} FROM {{tests}}""",
    "HILAB": f"""
SELECT CAST(l_orderkey AS STRING) AS `Código Da Cápsula`, {STATE_CODE} AS Estado, {_CITY} AS Cidade, {_DMY} AS `Data Do Exame`,
  {pick("l_partkey % 5", ["Covid-19 Antígeno", "Influenza A", "Influenza B", "Zika IgG", "Outro"])} AS Exame,
  {pick("l_suppkey % 4", ["Reagente", "Não Reagente", "Inválido", "Ilegível"])} AS Resultado, CAST({AGE} AS STRING) AS Idade,
  concat('P', CAST(o_custkey AS STRING)) AS Paciente, {SEX} AS Sexo, {_FILE} FROM {{tests}}""",
    "HPARDINI": f"""
SELECT CAST(l_orderkey AS STRING) AS CODIGO, {_DAY_TEXT} AS DATACOLETA, {pick("l_partkey % 4", ["SARS-CoV-2", "DENV", "RSV", "SARS-CoV-2"])} AS `PATÓGENO`,
  {pick("o_orderkey % 3", ["PCR em Tempo Real", "Antígeno", "PCR EM TEMPO REAL "])} AS `MÉTODO`, {_CITY} AS CIDADE, {STATE_CODE} AS UF, {SEX} AS SEXO,
  CAST({AGE} AS STRING) AS IDADE, {pick("l_suppkey % 3", ["Positivo", "Negativo", "Indeterminado"])} AS RESULTADO, {_FILE} FROM {{tests}}""",
    "SABIN": f"""
SELECT CAST(l_orderkey AS STRING) AS OS, {STATE} AS Estado, {_CITY} AS Municipio, {_MDY} AS DataAtendimento, {_BIRTH_MDY} AS DataNascimento, {SEX} AS Sexo,
  {pick("o_orderkey % 4", ["PAINEL MOLECULAR PARA INFECÇÕES RESPIRATÓRIAS II", "Painel para vírus SARS-CoV-2, Influenza A, B e sincicial respiratório", "PCR", "Antígeno"])} AS Descricao,
  {pick("l_partkey % 12", ["INFLUA", "INFLUB", "RSVA", "HRV", "NALVO", "RDRPALVO", "COVIDECO", "PARA1", "PCRVRESPBM", "BP", "HBSAG", "PCRVRESPBM3"])} AS Parametro,
  {pick("l_suppkey % 7", ["Detectado", "Não detectado", "Influenza A", "0", "Reagente", "Não reagente fraco", "Ilegível"])} AS Resultado, {_FILE} FROM {{tests}}""",
    "TARGET": f"""
SELECT concat('0', CAST(l_orderkey AS STRING)) AS `Numerdo do Pedido`, CAST(l_partkey AS STRING) AS `Código da Amostra`, {_DMY} AS `Data de Coleta`, {SEX} AS Sexo,
  {_AGE_TEXT} AS Idade, {_CITY} AS `Município`, {STATE_CODE} AS Estado, {pick("o_orderkey % 5", ["rescap02", "COV19SWI", "RESCAP04", "DENVQL", "NOVO"])} AS Exame,
  'Painel' AS `Nome exame`, {pick("l_partkey % 8", ["CVNCOV", "FLUA", "FLUB", "RSVAB", "HRV", "HADV", "MYCOPN", "SARS"])} AS `Cód. Pátógeno`, 'x' AS `Patógeno`,
  {pick("l_suppkey % 5", ["Detectado", "Não detectado", "Indeterminado", "Detectado (Presença do RNA de coronavírus SARS-CoV-2)", "Ilegível"])} AS Resultado,
  {_FILE} FROM {{tests}}""",
}

# the laboratory with one row per sample: three layouts, other columns empty
_HLAGYN_USED = {
    "Resultado": (0, 3), "Vírus Influenza A": (1, 4), "Vírus Influenza B": (1, 5), "Vírus Sincicial Respiratório A/B": (1, 6),
    "Coronavírus SARS-CoV-2": (1, 7), "VIRUS_IA": (2, 4), "VIRUS_H1N1": (2, 5), "VIRUS_B": (2, 6), "VIRUS_RH": (2, 7),
    "VIRUS_PH": (2, 3), "VIRUS_PH2": (2, 8), "BACTE_MP": (2, 9),
}
_HLAGYN_WORDS = ["Detectado", "Não detectado", "Inconclusivo", None, "Não Detectado (NEG)", "Ilegível"]


def _hlagyn_column(header: str) -> str:
    if header not in _HLAGYN_USED:
        return f"CAST(NULL AS STRING) AS `{header}`"
    layout, step = _HLAGYN_USED[header]
    return f"CASE WHEN o_orderkey % 3 = {layout} THEN {pick(f'(l_partkey * {step} + l_suppkey) % 6', _HLAGYN_WORDS)} END AS `{header}`"


RAW["HLAGYN"] = (
    f"SELECT CAST(l_orderkey AS STRING) AS Pedido, {_DAY_TEXT} AS `Data Coleta`, CAST({AGE} AS STRING) AS Idade, {SEX} AS Sexo, "
    f"{pick('o_orderkey % 2', ['RT-PCR', ' Painel'])} AS `Métodologia`, {_CITY} AS Cidade, {STATE_CODE} AS UF, "
    + ", ".join(_hlagyn_column(h) for h in lv.HLAGYN_RESULT_HEADERS)
    + f", {_FILE} FROM {{tests}}"
)

# the register: coded columns written as decimals
_CODES = {
    "AN_SARS2": (7, ["1.0", "2.0", "9"]), "AN_VSR": (11, ["1"]), "AN_PARA1": (13, ["1.0"]), "AN_PARA3": (17, ["1"]),
    "AN_ADENO": (19, ["1", "0.4"]), "PCR_SARS2": (3, ["1.0", "0"]), "PCR_VSR": (4, ["1.0", "0.0", "9"]), "PCR_PARA2": (23, ["1"]),
    "PCR_ADENO": (29, ["1"]), "PCR_METAP": (31, ["1"]), "PCR_BOCA": (37, ["1"]), "PCR_RINO": (8, ["1.0", "0"]),
    "TP_FLU_AN": (5, ["1.0", "2.0"]), "POS_AN_FLU": (3, ["1.0", "2.0", "9.0"]), "TP_FLU_PCR": (3, ["1.0", "2"]),
    "POS_PCRFLU": (2, ["1.0", "2.0"]),
}


def _register_column(name: str) -> str:
    fixed = {
        "NM_UN_INTE": "concat('UNIDADE ', CAST(o_custkey % 50 AS STRING))",
        "CS_SEXO": pick("o_orderkey % 3", ["F", "M", "I"]),
        "NU_IDADE_N": "concat(CAST(o_custkey % 100 AS STRING), '.0')",
        "TP_IDADE": pick("o_orderkey % 4", ["3.0", "2.0", "3", "1"]),
        "DT_COLETA": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(dt AS STRING) END",
        "DT_SIN_PRI": "CAST(dt - CAST(o_orderkey % 9 AS INT) AS STRING)",
        "AMOSTRA": pick("o_orderkey % 10", ["2.0"], "1.0"),
        "ID_MN_RESI": PLACE,
        "SG_UF": pick("c_nationkey", STATE_CODES),
        "CO_MUN_RES": "concat(CAST(1000000 + c_nationkey * 100 + o_custkey % 8 AS STRING), '.0')",
        "CLASSI_FIN": pick("o_custkey % 6", ["4"], "5.0"),
        "CRITERIO": "'1;'",
    }
    if name in fixed:
        return f"{fixed[name]} AS {name}"
    if name in _CODES:
        step, values = _CODES[name]
        return f"{pick(f'(o_orderkey + o_custkey) % {step}', values)} AS {name}"
    return f"CAST(NULL AS STRING) AS {name}"


REGISTER = (
    "SELECT " + ", ".join(_register_column(c) for c in lv.REGISTER_COLUMNS) + ", 'register.csv' AS file_name FROM {cases}"
)

# the archive: wide rows with text results
_ARCHIVE_RESULTS = ", ".join(
    f"{pick(f'(o_orderkey + {7 * i + 3}) % {i % 4 + 3}', ['Pos', 'Neg'], 'NT')} AS {p}_test_result"
    if p != "SC2"
    else f"{pick('o_orderkey % 7', ['Pos', 'Neg', 'Inconclusivo'], 'NT')} AS SC2_test_result"
    for i, p in enumerate(vocab.PATHOGENS)
)
ARCHIVE = f"""
SELECT CAST(o_orderkey AS STRING) AS sample_id, {pick("o_orderkey % 4", ["DB Mol", "HLAGyn", "DASA", "Sabin"])} AS lab_id, CAST(o_orderkey AS STRING) AS test_id,
  {pick(f"o_orderkey % {len(KITS)}", KITS)} AS test_kit, CAST(dt AS STRING) AS date_testing, {STATE_CODE} AS state_code,
  concat('P', CAST(o_custkey AS STRING)) AS patient_id, {pick("o_orderkey % 3", ["F", "M", "Z"])} AS sex,
  concat(CAST(o_custkey % 90 - 2 AS STRING), '.0') AS age, {_ARCHIVE_RESULTS}, {PLACE} AS location, {STATE} AS state FROM {{cases}}"""


# -- engines -----------------------------------------------------------------


def most_nations(sql: str) -> str:
    """Deriving SQL in which one state takes the customers of a third of the keys only."""
    return sql.replace(_NATION, _NATION_OF_MOST)


def spark_table(spark: SparkSession, sf_dir: str, sql: str, **derived: DataFrame) -> DataFrame:
    """Run deriving SQL on Spark; ``{name}`` is a driver table or one of the frames given."""
    frames = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **frames, **derived)


def shares(spark: SparkSession, sf_dir: str, name: str = "lineitem") -> int:
    """Shares of ``PER_TASK`` bytes that a table's files hold."""
    path = f"{sf_dir}/{name}.parquet"
    return -(-Storage(spark, path).size(path) // PER_TASK)


def tasks(spark: SparkSession, sf_dir: str, name: str = "lineitem") -> int:
    """Tasks that a table's rows are dealt to: their number grows with the files, the rows of one do not."""
    return max(spark.sparkContext.defaultParallelism, shares(spark, sf_dir, name))


def tests(spark: SparkSession, sf_dir: str, derive: Derive = str) -> DataFrame:
    """``tests_sql`` on Spark. The rows widen after this join, so its tasks take a fixed share of the line items."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    n, dated = tasks(spark, sf_dir), cases(spark, sf_dir, derive)
    items = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).repartition(n, "l_orderkey")
    joined = items.join(dated.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*lineitem.columns, *dated.columns, "p_size", "p_brand")


def cases(spark: SparkSession, sf_dir: str, derive: Derive = str) -> DataFrame:
    return spark_table(spark, sf_dir, derive(cases_sql("spark")))


def long_results(spark: SparkSession, sf_dir: str, derive: Derive = str) -> DataFrame:
    return spark.sql(LONG, tests=tests(spark, sf_dir, derive))


def raw(spark: SparkSession, sf_dir: str, lab_id: str) -> DataFrame:
    return spark.sql(RAW[lab_id], tests=tests(spark, sf_dir))


def dealt_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated orders as evenly dealt tasks: rows widen from here, and the files of the orders may be few and large."""
    return cases(spark, sf_dir).repartition(tasks(spark, sf_dir, "orders"), "o_orderkey")


def raw_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REGISTER, cases=dealt_cases(spark, sf_dir))


def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ARCHIVE, cases=dealt_cases(spark, sf_dir))


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_table(spark, sf_dir, MUNICIPALITIES)


def macroregions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MACROREGIONS, municipalities=municipalities(spark, sf_dir))


def duck(sql: str, **names: str) -> str:
    """Deriving SQL for DuckDB: table names in place of the frames, double quotes for back-ticks."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    for name in ("tests", "cases", "municipalities"):
        sql = sql.replace("{" + name + "}", names.get(name, name))
    sql = sql.replace("try_element_at(array(", "list_extract(list_value(")
    return sql.replace("`", '"')


DUCK_TESTS = f"tests AS ({duck(tests_sql('duck'))})"
DUCK_CASES = f"cases AS ({duck(cases_sql('duck'))})"
DUCK_GEOGRAPHY = f"municipalities AS ({duck(MUNICIPALITIES)}), macroregions AS ({duck(MACROREGIONS)})"
