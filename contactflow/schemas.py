"""Declared schemas of the stored tables."""

from __future__ import annotations

TABLES = {
    "clients": "id long, rut string, dv string, nome string, sexo string, data_nascimento date, staging_id long",
    "addresses": "id long, cliente_id long, direccion string, comuna string, region string",
    "phones": "id long, cliente_id long, numero string, origem string, staging_id long",
    "emails": "id long, cliente_id long, endereco string, origem string, staging_id long",
    "state": (
        "id long, cliente_id long, resposta_id int, telefone_id long, email_id long, status string,"
        " extraido int, data_extracao timestamp_ntz, data_criacao timestamp_ntz, data_update timestamp_ntz"
    ),
    "imports": (
        "id long, filename string, total_rows long, rows_success long, rows_failed long, status string,"
        " created_at timestamp_ntz, started_at timestamp_ntz, finished_at timestamp_ntz"
    ),
    "import_rows": (
        "staging_id long, row_idx long, raw_rut string, raw_nome string, normalized_rut string,"
        " normalized_dv string, validation_status string, validation_message string, processed_at timestamp_ntz"
    ),
}

#: Tables kept as a base and a log of changed rows, by this key.
LOGGED = {"state": "id"}
#: Tables kept in hash buckets: key and number of buckets.
BUCKETED = {"addresses": (["cliente_id"], 64)}
