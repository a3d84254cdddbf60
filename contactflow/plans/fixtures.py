"""Synthetic inputs derived from the given tables.

Each input is one SELECT in a dialect that Spark and DuckDB share, so both
sides of a comparison start from the same rows. `{name}` is a given table or
another input. Every input keeps all rows of the table it is derived from.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.fixed_values import CONTRACT_OUTCOMES, OUTCOMES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


INPUTS = {
    # --- raw files -----------------------------------------------------------
    "raw_clients": """
        SELECT o AS line_no,
          CASE WHEN o % 7 = 0 THEN lpad(rut, 9, '0')
               WHEN o % 7 = 1 THEN '1.' || lpad(CAST(CAST(floor(c / 1000) AS BIGINT) % 1000 AS STRING), 3, '0')
                                   || '.' || lpad(CAST(c % 1000 AS STRING), 3, '0')
               WHEN o % 7 = 2 THEN '  ' || rut || '  '
               WHEN o % 7 = 3 AND o % 5 = 0 THEN ''
               WHEN o % 7 = 4 AND o % 11 = 0 THEN 'SIN RUT'
               WHEN o % 7 = 5 AND o % 13 = 0 THEN '99' || rut
               ELSE rut END AS rut,
          CASE c % 13 WHEN 11 THEN 'k' WHEN 12 THEN 'Z' ELSE CAST(c % 10 AS STRING) END AS dv,
          'Customer#' || lpad(CAST(c AS STRING), 9, '0') AS nombre,
          CASE o % 6 WHEN 0 THEN 'MUJER' WHEN 1 THEN 'VARON' WHEN 2 THEN 'VARÓN'
                     WHEN 3 THEN 'f' WHEN 4 THEN 'M' ELSE '?' END AS sexo,
          CASE WHEN o % 9 = 0 THEN ' CALLE ' || CAST(o AS STRING) || ' ' ELSE 'CALLE ' || CAST(o AS STRING) END AS direccion,
          CASE o % 12 WHEN 0 THEN 'VINA D' WHEN 1 THEN 'ÑUÑOA' WHEN 2 THEN 'ESTACION CENTR'
                      WHEN 3 THEN 'G.CARREÑO' WHEN 4 THEN 'DEPTO' WHEN 5 THEN 'REGION METROPOL'
                      WHEN 6 THEN 'CALLE 12' WHEN 7 THEN '.X' WHEN 8 THEN 'AB' WHEN 9 THEN 'MAIPU..'
                      WHEN 10 THEN 'REÑACA ALTO C' ELSE 'LOS  ANGELES' END AS comuna,
          CASE o % 8 WHEN 0 THEN 'METROPOLIT' WHEN 1 THEN 'DE VALPARA' WHEN 2 THEN 'DEL MAULE'
                     WHEN 3 THEN 'DE VALPARAISO' WHEN 4 THEN 'CHILE' WHEN 5 THEN 'de coquimbo'
                     WHEN 6 THEN 'DE NUBLE' ELSE '' END AS region,
          CASE o % 5 WHEN 0 THEN replace(substr(ts, 1, 10), '-', '') WHEN 1 THEN substr(ts, 1, 10)
                     WHEN 2 THEN ts WHEN 3 THEN '20240230' ELSE '' END AS fecha_nac
        FROM (SELECT o_orderkey AS o, o_custkey AS c, CAST(1000000 + o_custkey AS STRING) AS rut,
                     CAST(o_orderdate AS STRING) AS ts FROM {orders}) s""",
    "raw_phones": """
        SELECT line_no, pk, sk,
          CASE WHEN pk % 17 = 0 THEN CAST(9000000 + c AS STRING) ELSE CAST(1000000 + c AS STRING) END AS rut,
          CASE k % 6 WHEN 0 THEN n WHEN 1 THEN '9' || n WHEN 2 THEN '+56 9 ' || n
                     WHEN 3 THEN '9-' || n WHEN 4 THEN '12345' ELSE '' END AS celular
        FROM (SELECT l_orderkey * 8 + l_linenumber AS line_no, l_orderkey + l_linenumber AS k,
                     l_partkey AS pk, l_suppkey AS sk, o_custkey AS c,
                     CAST(20000000 + l_partkey AS STRING) AS n
              FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey) s""",
    "raw_emails": """
        SELECT event_id AS line_no,
          CAST(CASE WHEN event_id % 19 = 0 THEN 9000000 ELSE 1000000 END + user_id AS STRING) AS rut,
          CASE WHEN event_id % 23 = 0 THEN ''
               WHEN event_id % 4 = 0 THEN 'USER' || CAST(event_id % 7 AS STRING) || '@EXAMPLE.ORG'
               ELSE 'user' || CAST(event_id % 7 AS STRING) || '@example.org' END AS email
        FROM {events}""",
    "macro_result": """
        SELECT e AS line_no, CAST(1000000 + u AS STRING) AS rut, CAST(u % 10 AS STRING) AS dv,
          CASE WHEN t = 'purchase' THEN n
               WHEN t = 'click' AND e % 3 = 0 THEN '+56 9 ' || n
               WHEN t = 'click' AND e % 3 = 1 THEN '9' || n
               WHEN t = 'click' THEN '12345' ELSE '' END AS telefone_validado,
          CASE WHEN t IN ('purchase', 'signup') AND e % 2 = 0 THEN 'User' || CAST(u AS STRING) || '@example.org'
               WHEN t = 'signup' THEN 'u' || CAST(u AS STRING) || '@example.org' ELSE '' END AS email_validado,
          CASE WHEN t = 'error' THEN '0' WHEN t = 'view' AND e % 3 = 0 THEN '' ELSE '1' END AS sucesso,
          CASE WHEN t <> 'error' THEN ''
               WHEN e % 4 = 0 THEN 'usuarioRegistrado' WHEN e % 4 = 1 THEN 'Read Timeout'
               WHEN e % 4 = 2 THEN 'Erro ou retorno desconhecido' ELSE 'ConnectionError: refused' END AS erro
        FROM (SELECT event_id AS e, user_id AS u, event_type AS t,
                     lpad(CAST(10000000 + 7 * event_id AS STRING), 8, '0') AS n FROM {events}) s""",
    "legacy_body": """
        SELECT event_id,
          CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '{{"CodigoRetorno":"' || lpad(CAST(event_id % 14 AS STRING), 3, '0') || '"}}'
            WHEN 2 THEN '{{"CodigoRetorno":' || CAST(event_id % 12 AS STRING) || '}}'
            WHEN 3 THEN 'Peak connections limit exceeded' WHEN 4 THEN 'ERRO_RETRY: ReadTimeout'
            WHEN 5 THEN 'alguma resposta' WHEN 6 THEN '123' ELSE NULL END AS body
        FROM {events}""",
    "answer_bodies": """
        SELECT line_no, rut,
          CASE WHEN sucesso = '1' THEN '<form><input id="telefono" value="' || telefone_validado
                    || '"><input id="correoElectronico" value="' || email_validado || '"></form>'
               WHEN erro = 'usuarioRegistrado' THEN '{{"motivoRetorno":"usuarioRegistrado"}}'
               WHEN erro = '' THEN '<html></html>'
               ELSE '<div class="alerta error"> ' || erro || ' </div>' END AS body
        FROM {macro_result}""",
    "texts": """
        SELECT event_id,
          CASE event_id % 9 WHEN 0 THEN 'Timeout' WHEN 1 THEN 'HTTP 503' WHEN 2 THEN 'ok' WHEN 3 THEN 'N/A'
            WHEN 4 THEN '' WHEN 5 THEN 'ERRO: DESTINATION NAME IS NULL' WHEN 6 THEN 'aTIVO'
            WHEN 7 THEN 'ATIVO' ELSE NULL END AS mensagem,
          CASE event_id % 5 WHEN 0 THEN 'FALSO' WHEN 1 THEN '0' WHEN 2 THEN '1' WHEN 3 THEN '' ELSE NULL END AS Error
        FROM {events}""",
    # --- tables --------------------------------------------------------------
    "clients": """
        SELECT c_custkey AS id, CAST(1000000 + c_custkey AS STRING) AS rut,
          CAST(c_custkey % 10 AS STRING) AS dv, c_name AS nome,
          CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sexo,
          CASE WHEN c_custkey % 9 = 0 THEN NULL
               ELSE CAST('1950-02-28' AS DATE) + CAST((17 * c_custkey) % 20000 AS INT) END AS data_nascimento,
          c_nationkey AS staging_id
        FROM {customer}""",
    "addresses": """
        SELECT o_orderkey AS id, o_custkey AS cliente_id, 'CALLE ' || CAST(o_orderkey AS STRING) AS direccion,
          CASE o_orderkey % 3 WHEN 0 THEN 'MAIPU' WHEN 1 THEN 'VINA DEL MAR' ELSE NULL END AS comuna,
          CASE o_orderkey % 2 WHEN 0 THEN 'DE VALPARAÍSO' ELSE 'DE COQUIMBO' END AS region
        FROM {orders}""",
    "phones": """
        SELECT l_orderkey * 8 + l_linenumber AS line_no, l_partkey AS pk, l_suppkey AS sk,
          o_custkey AS cliente_id, '9' || lpad(CAST(l_partkey % 500 AS STRING), 8, '1') AS numero,
          CASE WHEN l_returnflag = 'R' THEN 'validado' ELSE 'enriquecimento' END AS origem
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "emails": """
        SELECT event_id AS id, user_id AS cliente_id,
          'user' || CAST(event_id % 7 AS STRING) || '@example.org' AS endereco,
          CASE WHEN event_type = 'purchase' THEN 'validado' ELSE 'enriquecimento' END AS origem
        FROM {events}""",
    "linked_phones": """
        SELECT o_orderkey AS id, o_custkey AS cliente_id,
          '9' || lpad(CAST(o_orderkey % 1000 AS STRING), 8, '2') AS numero, 'validado' AS origem
        FROM {orders}""",
    "respostas": f"SELECT * FROM (VALUES {_values(OUTCOMES)}) t(id, mensagem, status)",
    "work_state": """
        SELECT id, cliente_id, status,
          CASE WHEN s = 'F' THEN CAST(1 + id % 8 AS INT) WHEN s = 'O' THEN 5 ELSE NULL END AS resposta_id,
          CASE WHEN status = 'telefone_validado' AND id % 5 <> 0 THEN id ELSE NULL END AS telefone_id,
          CASE WHEN s = 'F' AND id % 4 = 0 THEN id ELSE NULL END AS email_id,
          CAST(id % 2 AS INT) AS extraido,
          CASE WHEN id % 2 = 1 THEN d ELSE NULL END AS data_extracao,
          d AS data_update
        FROM (SELECT o_orderkey AS id, o_custkey AS cliente_id, o_orderstatus AS s, o_orderdate AS d,
                CASE WHEN o_orderstatus = 'O' THEN 'pendente' WHEN o_orderstatus = 'P' THEN 'processando'
                     WHEN o_custkey % 3 = 0 THEN 'telefone_nao_validado' ELSE 'telefone_validado' END AS status
              FROM {orders}) s""",
    "work_state_u": """
        SELECT w.* FROM {work_state} w
        JOIN (SELECT max(id) AS id FROM {work_state} GROUP BY cliente_id) m ON w.id = m.id""",
    "imports": """
        SELECT n_nationkey AS id, 'carga_' || CAST(n_nationkey % 20 AS STRING) || '.csv' AS filename,
          CAST(1000 + n_nationkey AS BIGINT) AS total_rows, CAST(900 AS BIGINT) AS rows_success,
          CAST(100 + n_nationkey AS BIGINT) AS rows_failed,
          CASE WHEN n_nationkey % 7 = 0 THEN 'failed' ELSE 'completed' END AS status,
          CAST(CAST('2026-04-01' AS DATE) + CAST(n_nationkey % 5 AS INT) AS TIMESTAMP) AS created_at
        FROM {nation}""",
    "staging_rows": """
        SELECT o_orderkey AS id, CAST(o_orderkey % 25 AS INT) AS staging_id,
          CAST(1000000 + o_custkey AS STRING) AS normalized_rut,
          CASE o_orderkey % 10 WHEN 0 THEN 'invalid' WHEN 1 THEN 'skipped' WHEN 2 THEN 'new' ELSE 'valid' END AS validation_status,
          CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS processed_at
        FROM {orders}""",
    "file_stats": """
        SELECT i.filename AS arquivo, i.created_at AS data_carga, s.cpfs_no_arquivo, s.ucs_ineditas,
               s.combos_processadas, s.combos_ativas
        FROM {imports} i JOIN (
          SELECT staging_id, count(DISTINCT normalized_rut) AS cpfs_no_arquivo,
            count(CASE WHEN validation_status IN ('new', 'valid') THEN 1 END) AS ucs_ineditas,
            count(CASE WHEN staging_id % 6 <> 5 THEN processed_at END) AS combos_processadas,
            CASE WHEN staging_id % 4 = 3 THEN NULL
                 ELSE count(CASE WHEN validation_status = 'valid' THEN processed_at END) END AS combos_ativas
          FROM {staging_rows} GROUP BY staging_id) s ON s.staging_id = i.id""",
    # --- older contract model ------------------------------------------------
    "contract_clients": """
        SELECT c_custkey AS id, CAST(1000000 + c_custkey AS STRING) AS cpf, c_name AS nome FROM {customer}""",
    "units": " UNION ALL ".join(
        f"""
        SELECT 10 * c_custkey + {r} AS id,
          CASE WHEN (c_custkey + {r}) % 5 = 0 OR c_custkey % 11 = 0 THEN -1 - c_custkey ELSE c_custkey END AS cliente_id,
          lpad(CAST(10 * c_custkey + {r} AS STRING), 10, '0') AS uc, {r % 2} AS distribuidora_id
        FROM {{customer}}"""
        for r in range(4)
    ),
    "suppliers": """
        SELECT CASE WHEN c_custkey % 3 = 0 THEN -1 - c_custkey ELSE c_custkey END AS cliente_id,
          CASE WHEN c_custkey % 3 = 1 THEN 'fornecedor1' ELSE 'fornecedor2' END AS fornecedor
        FROM {customer} UNION ALL
        SELECT CASE WHEN c_custkey % 30 = 1 THEN c_custkey ELSE -1 - c_custkey END, 'fornecedor2'
        FROM {customer}""",
    "companies": "SELECT r_regionkey AS id, r_name AS nome FROM {region}",
    "contract_respostas": f"SELECT * FROM (VALUES {_values(CONTRACT_OUTCOMES)}) t(id, mensagem, status)",
    "contract_state": """
        SELECT o_orderkey AS id, o_custkey AS cliente_id, CAST(o_orderkey % 2 AS INT) AS distribuidora_id,
          CASE WHEN o_orderkey % 3 = 0 AND (o_custkey + o_orderkey % 2) % 5 <> 0
               THEN 10 * o_custkey + o_orderkey % 2 ELSE NULL END AS cliente_uc_id,
          CASE WHEN o_orderstatus = 'O' THEN 'pendente' WHEN o_orderstatus = 'P' THEN 'reprocessar'
               WHEN o_orderkey % 2 = 0 THEN 'consolidado' ELSE 'excluido' END AS status,
          CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 4 = 0 THEN 3 ELSE CAST(o_orderkey % 12 AS INT) END
               WHEN o_orderkey % 9 = 0 THEN NULL ELSE 6 END AS resposta_id,
          CAST(floor(o_orderkey / 2) AS BIGINT) % 2 AS extraido,
          CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderdate END AS data_extracao,
          o_orderdate AS data_update
        FROM {orders}""",
    "history": """
        SELECT CAST(1000000 + o_custkey AS STRING) AS cpf, lpad(CAST(l_partkey % 40 AS STRING), 10, '0') AS uc,
          CAST(l_suppkey % 2 AS STRING) AS distribuidora_id,
          CASE WHEN l_returnflag = 'R' AND o_custkey % 3 = 0 AND l_linenumber <= 2 THEN '3' ELSE '4' END AS resposta_id
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "contract_addresses": " UNION ALL ".join(
        f"""
        SELECT 10 * c_custkey + {j} AS id, c_custkey AS cliente_id, {j} AS distribuidora_id,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'RUA ' || CAST(c_custkey AS STRING) END AS endereco,
          CAST(c_custkey % 100 AS STRING) AS numero,
          CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'AP {j}' END AS complemento, 'CENTRO' AS bairro,
          'CIDADE ' || CAST(c_custkey % 10 AS STRING) AS cidade, 'BA' AS uf,
          lpad(CAST(c_custkey AS STRING), 8, '0') AS cep
        FROM {{customer}}"""
        for j in range(2)
    ),
}

# Sort columns that make a row of these inputs unique.
PHONE_ORDER = ["line_no", "pk", "sk"]


def names_in(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)))


class Inputs:
    """Given tables and derived inputs of one data folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in INPUTS:
            sql = INPUTS[name]
            return self.spark.sql(sql, **{n: getattr(self, n) for n in names_in(sql)})
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)


def duckdb_input(name: str) -> str:
    """The same SELECT with plain table names."""
    sql = INPUTS[name]
    return sql.format(**{n: n for n in names_in(sql)})


def with_inputs(sql: str) -> str:
    """Prefixes a DuckDB query with the inputs it names, in dependency order."""
    ordered: list[str] = []

    def visit(text: str):
        for name in INPUTS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(duckdb_input(name))
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    ctes = [f"{n} AS ({duckdb_input(n).strip()})" for n in ordered]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join([*ctes, body[5:]]) if ctes else body
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
