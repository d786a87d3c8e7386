"""Bronze to silver: strict types, clean text, no duplicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from quaylake.functions.casting import quoted, strict_casts
from quaylake.functions.text import clean_text
from quaylake.functions.time import iso_to_timestamp, processing_time
from quaylake.operators.filters import keys_present

# Columns of the two silver tables and their types, in order.
SUPERVISOR_TYPES = {
    "dtadmissao": "timestamp",
    "dtdemissao": "timestamp",
    "percomissao": "double",
    "vlcorrente": "double",
    "cod_cadrca": "double",
    "percpartvendaprev": "int",
    "percmargemprev": "int",
    "codcoordenador": "int",
    "vllimcred": "bigint",
    "dt_vmais": "bigint",
    "_ingestion_ts_utc": "string",
    "_ingestion_date": "date",
}

INVOICE_KEYS = {
    "codfilial": "int",
    "data_faturamento": "timestamp",
    "numnota": "bigint",
    "codigo": "bigint",
    "codcli": "int",
}
INVOICE_TYPES = {
    **INVOICE_KEYS,
    "mes": "int",
    "ano": "int",
    "horafat": "int",
    "minutofat": "int",
    "codativprinc": "decimal(18,4)",
    "codfornec": "bigint",
    "codsupervisor": "int",
    "codusur": "int",
    "codsec": "int",
    "codcategoria": "bigint",
    "codsubcategoria": "bigint",
    "codicmtab": "decimal(18,6)",
    "codativ": "decimal(18,4)",
    "codplpag": "decimal(38,0)",
    "numped": "decimal(38,0)",
    "numnotadev": "bigint",
}
INVOICE_MEASURES = (
    "qtd", "qtdevol", "peso", "pesoliq", "valortotal", "ptabela", "valor_liquido", "custofinest",
    "custoreal", "perc_lucro", "valorbonificado", "vldevolucao", "percdescdsv", "valor_dsv",
    "valor_dsv_2", "percdescfin",
)
INVOICE_MEASURE_TYPE = "decimal(18,6)"
INVOICE_TEXTS = (
    "cliente", "ramo", "ramoprincipal", "tiporamo", "tipovenda", "produto", "embalagem", "litragem",
    "fornecedor", "supervisor", "nomerca", "secao", "contrato", "categoria", "subcategoria",
)


def supervisors(bronze: DataFrame) -> DataFrame:
    """Supervisors: the named columns cast strictly, exact duplicates removed."""
    return bronze.select(*strict_casts(SUPERVISOR_TYPES)).distinct()


def invoices(bronze: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Invoice lines with all keys present: cast, trimmed, deduplicated, stamped.

    The processing time is the same for every row, so it is added after the deduplication and
    does not travel through its shuffle.
    """
    measures = {name: INVOICE_MEASURE_TYPE for name in INVOICE_MEASURES}
    treated = keys_present(bronze, list(INVOICE_KEYS)).select(
        *strict_casts({**INVOICE_TYPES, **measures}),
        *[clean_text(quoted(name)).alias(name) for name in INVOICE_TEXTS],
        iso_to_timestamp(quoted("_ingestion_ts_utc")).alias("_ingestion_ts_utc"),
        quoted("_ingestion_date").cast("date").alias("_ingestion_date"),
    )
    return treated.distinct().withColumn("_silver_ts_utc", processing_time(as_of))
