"""Steps of the laboratories stay within what the JVM compiles: a method of more than 8000 bytes runs uncompiled."""

import re

import pytest

from labwatch import labs_vocab as lv
from labwatch.plans.labs import LABS

ROWS = {
    "DBMOL": {
        "NumeroPedido": "007", "Sexo": "F", "Procedimento": "Painel", "CodigoProcedimento": "COVI19Q", "Parametro": "COVI19Q", "DataCadastro": "2026-01-05",
        "DataNascimento": "1990-02-01", "Cidade": " São José ", "UF": "SP", "Resultado": "Superior a 31.5", "file_name": "a.csv",
    },
    "TARGET": {
        "Numerdo do Pedido": "07", "Código da Amostra": "1", "Data de Coleta": "05/01/2026", "Sexo": "F", "Idade": "30A", "Município": "São José", "Estado": "SP",
        "Exame": "COV19SWI", "Nome exame": "Painel", "Cód. Pátógeno": "CVNCOV", "Patógeno": "x", "Resultado": "Detectado", "file_name": "a.csv",
    },
}


def largest_method(spark, build, row, capsys):
    """Bytes of the largest method that the plan compiles to, and its result rows."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    names = list(row)
    raw = own.createDataFrame([tuple(row.values())], ", ".join(f"`{n}` string" for n in names))
    df = build(raw)
    capsys.readouterr()
    df.explain(mode="codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)), df.collect()


@pytest.mark.parametrize("lab_id", list(ROWS))
def test_laboratory(spark, capsys, lab_id):
    size, rows = largest_method(spark, LABS[lab_id].wide, ROWS[lab_id], capsys)
    assert size < 8000
    assert [(r["test_id"], r["location"], r["state"], r["SC2_test_result"]) for r in rows] == [("7", "SAO JOSE", "SAO PAULO", "Pos")]


def test_laboratory_of_many_result_columns(spark, capsys):
    row = {
        "Pedido": "7", "Data Coleta": "2026-01-05", "Idade": "30", "Sexo": "F", "Métodologia": "RT-PCR", "Cidade": " São José ", "UF": "SP",
        **dict.fromkeys(lv.HLAGYN_COLUMNS), "Coronavírus SARS-CoV-2": " não detectado\t", "Vírus Influenza A": "Detectado", "file_name": "a.csv",
    }
    size, rows = largest_method(spark, LABS["HLAGYN"].wide, row, capsys)
    assert size < 8000
    assert [(r["location"], r["test_kit"], r["SC2_test_result"], r["FLUA_test_result"], r["FLUB_test_result"]) for r in rows] == [("SAO JOSE", "test_4", "Neg", "Pos", "NT")]
