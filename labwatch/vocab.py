"""Fixed values.

Names, codes, word lists, cut-offs and dates below must equal those used by
the laboratories and by the published tables, so they are stated as they are.
"""

from __future__ import annotations

# -- pathogens ---------------------------------------------------------------

PATHOGENS = ["SC2", "FLUA", "FLUB", "VSR", "META", "RINO", "PARA", "ADENO", "BOCA", "COVS", "ENTERO", "BAC"]
RESULT_COLUMNS = [f"{p}_test_result" for p in PATHOGENS]

POSITIVE, NEGATIVE, NOT_TESTED, UNRECOGNISED, UNDETERMINED = 1, 0, -1, -2, -3
NOT_REPORTED = "NOT REPORTED"

PATHOGEN_LABELS = {
    "SC2": "SARS-CoV-2",
    "FLUA": "Influenza A",
    "FLUB": "Influenza B",
    "VSR": "Vírus Sincicial Respiratório",
    "META": "Metapneumovírus",
    "RINO": "Rinovírus",
    "PARA": "Vírus Parainfluenza",
    "ADENO": "Adenovírus",
    "BOCA": "Bocavírus",
    "COVS": "Coronavírus sazonais",
    "ENTERO": "Enterovírus",
    "BAC": "Bactérias",
}

# lower-cased label -> spelling kept in running text
LABEL_SPELLING = {
    "influenza a": "influenza A",
    "influenza b": "influenza B",
    "sars-cov-2": "SARS-CoV-2",
    "vsr": "VSR",
}

# -- geography ---------------------------------------------------------------

STATE_NAMES = {
    "AC": "ACRE",
    "AL": "ALAGOAS",
    "AP": "AMAPA",
    "AM": "AMAZONAS",
    "BA": "BAHIA",
    "CE": "CEARA",
    "DF": "DISTRITO FEDERAL",
    "ES": "ESPIRITO SANTO",
    "GO": "GOIAS",
    "MA": "MARANHAO",
    "MT": "MATO GROSSO",
    "MS": "MATO GROSSO DO SUL",
    "MG": "MINAS GERAIS",
    "PA": "PARA",
    "PB": "PARAIBA",
    "PR": "PARANA",
    "PE": "PERNAMBUCO",
    "PI": "PIAUI",
    "RJ": "RIO DE JANEIRO",
    "RN": "RIO GRANDE DO NORTE",
    "RS": "RIO GRANDE DO SUL",
    "RO": "RONDONIA",
    "RR": "RORAIMA",
    "SC": "SANTA CATARINA",
    "SP": "SAO PAULO",
    "SE": "SERGIPE",
    "TO": "TOCANTINS",
}

REGION_LABELS = {
    "NORTE": "Norte",
    "NORDESTE": "Nordeste",
    "CENTRO-OESTE": "Centro-Oeste",
    "SUDESTE": "Sudeste",
    "SUL": "Sul",
}
REGIONS = ["Centro-Oeste", "Nordeste", "Norte", "Sudeste", "Sul"]

# spelling found in files -> state name; state codes typed as names count too
STATE_FIXES = {
    "CUIABA": "MATO GROSSO",
    "CONTROL LAB": "NOT REPORTED",
    "VALUE": "NOT REPORTED",
    "HOSPITAL": "DISTRITO FEDERAL",
    **STATE_NAMES,
}

# (location, state) -> location
LOCATION_FIXES = {
    ("ALPHAVILLE", "SAO PAULO"): "SAO PAULO",
    ("GOIANA", "GOIAS"): "GOIANIA",
    ("MOJI DAS CRUZES", "SAO PAULO"): "MOGI DAS CRUZES",
    ("SALVADORBA", "BAHIA"): "SALVADOR",
    ("SANTO AMARO", "SAO PAULO"): "SAO PAULO",
    ("UBERBA", "MINAS GERAIS"): "UBERABA",
    ("EMBUGUACU", "SAO PAULO"): "EMBU GUACU",
    ("JIPARANA", "RONDONIA"): "JI PARANA",
    ("JABOATAO", "PERNAMBUCO"): "JABOATAO DOS GUARARAPES",
    ("GUARILHOS", "SAO PAULO"): "GUARULHOS",
    ("SAO CAETANO", "SAO PAULO"): "SAO CAETANO DO SUL",
    ("BOA VISTA", "AMAZONAS"): "BOA VISTA DO RAMOS",
}

RIO_DE_JANEIRO_CODE = 3304557

LAB_ID_FIXES = {"DB Mol": "DBMOL", "HLAGyn": "HLAGYN"}

# -- dimensions --------------------------------------------------------------

# (age_group, min_age, max_age), both ends included
AGE_BANDS = [
    ("00-04", -1, 4),
    ("05-09", 5, 9),
    ("10-19", 10, 19),
    ("20-29", 20, 29),
    ("30-39", 30, 39),
    ("40-49", 40, 49),
    ("50-59", 50, 59),
    ("60-69", 60, 69),
    ("70-79", 70, 79),
    ("80+", 80, 1000),
]

TEST_METHODS = {
    "adeno_pcr": "PCR singleplex",
    "bac_antigen": "Antígeno singleplex",
    "bac_igg": "Sorologia (IgG)",
    "bac_igm": "Sorologia (IgM)",
    "bac_pcr": "PCR singleplex",
    "covid_antibodies": "Sorologia multiplex",
    "covid_antigen": "Antígeno singleplex",
    "covid_iga": "Sorologia (IgA)",
    "covid_pcr": "PCR singleplex",
    "flu_antigen": "Antígeno multiplex",
    "flu_pcr": "PCR multiplex",
    "flua_igg": "Sorologia (IgG)",
    "flua_igm": "Sorologia (IgM)",
    "flub_igg": "Sorologia (IgG)",
    "flub_igm": "Sorologia (IgM)",
    "test_14": "PCR multiplex",
    "test_21": "PCR multiplex",
    "test_23": "PCR multiplex",
    "test_24": "PCR multiplex",
    "test_3": "PCR multiplex",
    "test_4": "PCR multiplex",
    "thermo": "PCR singleplex",
    "vsr_antigen": "Antígeno singleplex",
    "vsr_igg": "Sorologia (IgG)",
}

# first and last day covered by the epidemiological calendar
CALENDAR_FIRST, CALENDAR_LAST = "2017-12-31", "2028-01-01"

# epidemiological week number from which a month label applies
MONTH_LABEL_STARTS = [
    (1, "Jan"), (5, "Fev"), (9, "Mar"), (13, "Abr"), (18, "Mai"), (22, "Jun"),
    (26, "Jul"), (31, "Ago"), (35, "Set"), (39, "Out"), (44, "Nov"), (48, "Dez"),
]

# -- panel -------------------------------------------------------------------

LAB_CUTOVER = "2024-01-01"
PANEL_START = "2021-10-01"
ARCHIVE_ONLY_LABS = ["DASA"]
ARCHIVE_FILE_LABEL = "COMBINED_HISTORICAL_DATA"
LOCAL_TIME_ZONE = "America/Sao_Paulo"

PANEL_COLUMNS = [
    "sample_id", "test_id", "test_kit", "sex", "age", "location", "date_testing", "state", "patient_id",
    "file_name", *RESULT_COLUMNS, "qty_original_lines", "created_at", "updated_at",
]
IDENTIFYING_COLUMNS = ["sample_id", "test_id", "lab_id", "file_name", "patient_id", "qty_original_lines"]

# -- test kits ---------------------------------------------------------------

SC2_KITS = ["thermo", "covid_antigen", "covid_pcr", "sc2_antigen", "test_4", "test_14", "test_21", "test_23", "test_24"]
SC2_ROUTED_KITS = ["thermo", "covid_antigen", "covid_pcr", "test_4", "test_14", "test_21", "test_23", "test_24"]
SC2_REGISTER_KITS = ["thermo", "covid_antigen", "covid_pcr", "sc2_antigen", "test_4", "test_14", "test_21", "test_24"]
FLU_KITS = ["flu_antigen", "flu_pcr", "test_3", "test_4", "test_14", "test_21", "test_23", "test_24"]
VSR_KITS = ["vsr_antigen", "test_3", "test_4", "test_14", "test_21", "test_23", "test_24"]
PANEL4_KITS = ["test_4", "test_21", "test_24"]
PANEL20_KITS = ["test_21", "test_24"]
MULTIPLEX_KITS = ["test_3", "test_4", "test_14", "test_21", "test_23", "test_24"]
WIDE_KITS = ["test_14", "test_21", "test_23", "test_24"]
ALL_REPORTED_KITS = [
    "adeno_pcr", "bac_antigen", "bac_pcr", "covid_antigen", "covid_pcr", "flu_antigen", "flu_pcr", "test_14",
    "test_21", "test_23", "test_24", "test_3", "test_4", "thermo", "vsr_antigen",
]

# pathogens a kit must report, neither more nor fewer
KIT_PATHOGENS = {
    "adeno_iga": ["ADENO"],
    "adeno_igg": ["ADENO"],
    "adeno_igm": ["ADENO"],
    "adeno_pcr": ["ADENO"],
    "adeno_antigen": ["ADENO"],
    "bac_antigen": ["BAC"],
    "bac_igg": ["BAC"],
    "bac_igm": ["BAC"],
    "bac_pcr": ["BAC"],
    "covid_antibodies": ["SC2"],
    "covid_antigen": ["SC2"],
    "covid_iga": ["SC2"],
    "covid_pcr": ["SC2"],
    "flu_antigen": ["FLUA", "FLUB"],
    "flua_antigen": ["FLUA"],
    "flub_antigen": ["FLUB"],
    "flu_pcr": ["FLUA", "FLUB"],
    "flua_pcr": ["FLUA"],
    "flub_pcr": ["FLUB"],
    "flua_igg": ["FLUA"],
    "flua_igm": ["FLUA"],
    "flub_igg": ["FLUB"],
    "flub_igm": ["FLUB"],
    "sc2_igg": ["SC2"],
    "vsr_antigen": ["VSR"],
    "vsr_igg": ["VSR"],
    "vsr_pcr": ["VSR"],
    "para_antigen": ["PARA"],
    "para_pcr": ["PARA"],
    "meta_pcr": ["META"],
    "boca_pcr": ["BOCA"],
    "rino_pcr": ["RINO"],
    "test_2": ["FLUA", "FLUB"],
    "test_3": ["FLUA", "FLUB", "VSR"],
    "test_4": ["SC2", "FLUA", "FLUB", "VSR"],
    "test_14": ["SC2", "FLUA", "FLUB", "VSR", "META", "RINO", "PARA", "ADENO", "BOCA", "COVS", "ENTERO"],
    "test_21": ["SC2", "FLUA", "FLUB", "VSR", "META", "RINO", "PARA", "ADENO", "COVS", "BAC"],
    "test_24": ["SC2", "FLUA", "FLUB", "VSR", "META", "RINO", "PARA", "ADENO", "BOCA", "COVS", "ENTERO", "BAC"],
}
