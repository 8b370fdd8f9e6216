"""The states of the country with their capitals, and lookups either way."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions.text import norm_python, norm_search

# States by their codes, and their capitals.
STATES = {
    "AC": "Acre", "AL": "Alagoas", "AP": "Amapá", "AM": "Amazonas", "BA": "Bahia", "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás", "MA": "Maranhão", "MT": "Mato Grosso",
    "MS": "Mato Grosso do Sul", "MG": "Minas Gerais", "PA": "Pará", "PB": "Paraíba", "PR": "Paraná", "PE": "Pernambuco", "PI": "Piauí", "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte",
    "RS": "Rio Grande do Sul", "RO": "Rondônia", "RR": "Roraima", "SC": "Santa Catarina", "SP": "São Paulo", "SE": "Sergipe", "TO": "Tocantins",
}
CAPITALS = {
    "AC": "Rio Branco", "AL": "Maceió", "AP": "Macapá", "AM": "Manaus", "BA": "Salvador", "CE": "Fortaleza", "DF": "Brasília", "ES": "Vitória", "GO": "Goiânia", "MA": "São Luís", "MT": "Cuiabá",
    "MS": "Campo Grande", "MG": "Belo Horizonte", "PA": "Belém", "PB": "João Pessoa", "PR": "Curitiba", "PE": "Recife", "PI": "Teresina", "RJ": "Rio de Janeiro", "RN": "Natal", "RS": "Porto Alegre",
    "RO": "Porto Velho", "RR": "Boa Vista", "SC": "Florianópolis", "SP": "São Paulo", "SE": "Aracaju", "TO": "Palmas",
}


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    """A constant map of some tens of entries: no join and no broadcast."""
    return F.coalesce(F.create_map(*(F.lit(x) for x in itertools.chain(*pairs.items())))[key], F.lit(""))


def state_name(code: Column) -> Column:
    return _lookup(STATES, F.upper(F.trim(code)))


def state_code(name: Column) -> Column:
    """The code of a state named with or without its accents, or given as its code."""
    return _lookup({norm_python(n): c for c, n in STATES.items()} | {c.lower(): c for c in STATES}, norm_search(name))


def is_capital(name: Column, code: Column) -> Column:
    return F.coalesce((norm_search(name) != "") & (_lookup({c: norm_python(n) for c, n in CAPITALS.items()}, F.upper(F.trim(code))) == norm_search(name)), F.lit(False))


def states(spark: SparkSession) -> DataFrame:
    """The dimension as a table: code, name, capital."""
    return spark.createDataFrame([(c, n, CAPITALS[c]) for c, n in STATES.items()], "code string, name string, capital string")
