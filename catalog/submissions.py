"""Submissions derived from the tables: one JSON document per order, for each of the forms.

Every field of a form has the SQL that puts a value into the document and, where repair or a
cast changes it, the SQL of the value the silver table must hold. Both dialects read it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from formtide.functions.columns import as_column
from formtide.plans.form_specs import FORM_SPECS

PROCESSED_AT = "2024-05-06 07:08:09"

# Paths of all fields the forms use.
PATHS = """
id info.date info.userId info.customerId
meta.serialNumber meta.registrationDate meta.location.latitude meta.location.longitude meta.device.name
data.regiao data.buscar.id data.buscar.REGIAO data.buscar.SETOR data.buscar.LOGRADOURO
data.buscar.FREQUENCIA data.buscar.EXTENSAOKM data.responsavel_setor data.varredor
data.servico_executado data.observacao data.foto data.foto1 data.foto2 data.foto3 data.foto4 data.foto5
data.buscar_veiculo.id data.buscar_veiculo.PLACA data.buscar_veiculo.TIPODEVEICULO
data.buscar_veiculo.MODELO data.buscar_veiculo.MARCA data.buscar_veiculo.ANODOMODELO
data.buscar_veiculo.lIMITEDACARGAPBTT data.buscar_veiculo.lIMITEDACARGAPBTCOMTOLERANCIAT
data.buscar_veiculos.id data.buscar_veiculos.PLACA data.buscar_veiculos.TIPODEVEICULO
data.buscar_veiculos.MODELO data.buscar_veiculos.MARCA data.buscar_veiculos.ANODOMODELO
data.buscar_veiculos.lIMITEDACARGAPBTT data.buscar_veiculos.lIMITEDACARGAPBTCOMTOLERANCIAT
data.nome_motorista data.coletor data.modelo_caminhao data.dataEHoraDaVistoria
data.location.location.road data.location.location.houseNumber data.location.location.city
data.location.location.postcode data.location.location.country
data.rota.SETOR data.rota.LOCAL data.rota.DIA data.rota.id
data.logradouros.setor data.logradouros.local data.logradouros.itinerario data.logradouros.rua
data.logradouros.rota data.logradouros.id
data.servioExecutadoConformePlanejado data.observao
data.peso_entrada data.peso_saida data.peso_total data.rotaDeColeta
data.localizao.coordinates.latitude data.localizao.coordinates.longitude
data.localizao.location.road data.localizao.location.city data.localizao.location.postcode
data.localizao.location.country data.localizao.formattedValue data.servioExecutado
""".split()
PATH_OF = {path.replace(".", "_"): path for path in PATHS}

REGISTERED = "1672531200000 + (o_orderkey - 25) * 3000000"
MESSY_WEIGHT = "CASE WHEN o_orderstatus = 'P' THEN 'abc' ELSE concat(' ', o_totalprice, ' ') END"
WEIGHT = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"

# Fields with a value of their own; all others hold their name and the order priority.
VALUES = {
    "id": "concat('S', o_orderkey)",
    "info.date": REGISTERED,
    "info.customerId": "o_custkey",
    "meta.registrationDate": f"concat({REGISTERED} + 1000, '.0')",
    "meta.location.latitude": "o_totalprice / 1000",
    "meta.location.longitude": "0 - c_acctbal",
    "data.buscar.id": "o_custkey",
    "data.buscar.EXTENSAOKM": "c_acctbal",
    "data.responsavel_setor": "concat('OperaÃ§Ã£o ', c_mktsegment)",
    "data.varredor": "CASE WHEN o_orderstatus = 'O' THEN 'N/A' ELSE c_name END",
    "data.observacao": "concat('N√£o poss√≠vel ', o_orderpriority)",
    "data.foto": "concat('gridfs://registrationFiles/', o_orderkey, '-1')",
    "data.foto2": "concat('gridfs://registrationFiles/', o_orderkey, '-2')",
    "data.foto3": "CASE WHEN o_orderstatus = 'F' THEN NULL"
    " ELSE concat('gridfs://registrationFiles/', o_orderkey, '-3') END",
    "data.buscar_veiculo.PLACA": "concat(' abc', o_custkey, 'x ')",
    "data.buscar_veiculo.lIMITEDACARGAPBTT": "concat('1', o_custkey)",
    "data.buscar_veiculo.lIMITEDACARGAPBTCOMTOLERANCIAT": "concat(o_custkey, 'd')",
    "data.nome_motorista": "concat('joão ', lower(c_mktsegment), '-d''água')",
    "data.dataEHoraDaVistoria": "CASE WHEN o_orderstatus = 'F' THEN '2024-05-06T07:08:09'"
    f" ELSE concat({REGISTERED}, '') END",
    "data.location.location.houseNumber": "o_custkey",
    "data.rota.id": "concat(o_orderkey, '')",
    "data.logradouros.id": "o_orderkey",
    "data.peso_entrada": MESSY_WEIGHT,
    "data.peso_saida": "o_totalprice / 2",
    "data.peso_total": MESSY_WEIGHT,
    "data.localizao.coordinates.latitude": "o_totalprice / 1000",
    "data.localizao.coordinates.longitude": "c_acctbal",
    "data.servioExecutado": "CASE o_orderstatus WHEN 'F' THEN 'Sim' WHEN 'O' THEN 'não'"
    " ELSE 'talvez' END",
}

# Values of the silver table where they are not the document's.
EXPECTED = {
    "meta.registrationDate": f"{REGISTERED} + 1000",
    "data.responsavel_setor": "concat('Operação ', c_mktsegment)",
    "data.varredor": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE c_name END",
    "data.observacao": "concat('Não possível ', o_orderpriority)",
    "data.buscar_veiculo.PLACA": "concat('ABC', o_custkey, 'X')",
    "data.buscar_veiculo.lIMITEDACARGAPBTCOMTOLERANCIAT": "NULL",
    "data.peso_entrada": WEIGHT,
    "data.peso_total": WEIGHT,
    "data.servioExecutado": "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END",
}
TITLED_DRIVER = (
    "concat('João ', upper(left(c_mktsegment, 1)), lower(substr(c_mktsegment, 2)), '-D''Água')"
)
INSPECTED = (
    "CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2024-05-06 07:08:09'"
    f" ELSE epoch_ms({REGISTERED}) END"
)
SQL_TYPES = {"text": "VARCHAR", "upper": "VARCHAR", "number": "DOUBLE", "yes_no": "BOOLEAN"}


def value_sql(path: str) -> str:
    return VALUES.get(path, f"concat('{path.split('.')[-1]} ', o_orderpriority)")


def document(paths: list[str]):
    """The fields as one nested JSON object, nulls included."""

    def build(prefix: str, below: list[str]):
        children: dict[str, list[str]] = {}
        for path in below:
            head, _, rest = path.partition(".")
            children.setdefault(head, []).append(rest)
        cells = []
        for name, rest in children.items():
            here = f"{prefix}.{name}" if prefix else name
            cell = F.expr(value_sql(here)) if rest == [""] else build(here, rest)
            cells.append(cell.alias(name))
        return F.struct(*cells)

    return F.to_json(build("", paths), {"ignoreNullFields": "false"})


def form_paths(form: str) -> list[str]:
    sources = [source for source, _, _ in FORM_SPECS[form].columns]
    return list(dict.fromkeys(PATH_OF[source] for source in sources if source in PATH_OF))


def orders_of_customers(t):
    return t.spread("orders").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


def submissions(t, form: str):
    """Raw submissions of a form: ``form, element``."""
    return orders_of_customers(t).select(
        F.lit(form).alias("form"), document(form_paths(form)).alias("element")
    )


def silver_sql(form: str) -> str:
    """The silver table of a form, straight from the tables."""
    cells = []
    for source, target, cast in FORM_SPECS[form].columns:
        if source not in PATH_OF:
            sql = f"TIMESTAMP '{PROCESSED_AT}'"
        elif cast == "title":
            sql = TITLED_DRIVER
        elif cast == "epoch_or_text":
            sql = INSPECTED
        else:
            path = PATH_OF[source]
            sql = EXPECTED.get(path, value_sql(path))
            sql = f"epoch_ms({sql})" if cast == "epoch_ms" else f"cast({sql} AS {SQL_TYPES[cast]})"
        cells.append(f'{sql} AS "{target}"')
    return f"SELECT {', '.join(cells)} FROM orders JOIN customer ON o_custkey = c_custkey"


def without_zone(df):
    """Timestamps as wall-clock values, as the oracle has them."""
    return df.select(
        *[
            (as_column(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else as_column(name))
            for name, kind in df.dtypes
        ]
    )
