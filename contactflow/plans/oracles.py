"""The registered queries again, as DuckDB SQL over the same inputs."""

from __future__ import annotations

from ..functions.fixed_values import (
    BAD_FIRST_CHARS,
    BODY_TEXT_RULES,
    CATALOGUE_STATUS,
    COMMUNE_CORRECTIONS,
    CONNECTION_ERRORS,
    CONTRACT_OUTCOMES,
    EXCLUDED_MESSAGES,
    EXPORT_FILE,
    REGION_PREFIXES,
    REGISTERED_USER_ERRORS,
    REPORT_REGIONS,
    REQUEST_ERROR_KEYWORDS,
    STATUS_LABELS,
    TRUNCATED_REGIONS,
    VALID_REGIONS,
)
from ..functions.text import WHITESPACE
from .fixtures import TABLES, with_inputs

NOW = "TIMESTAMP '2026-04-07 12:00:00'"
FINAL = "(1, 2, 3, 6, 7, 8)"


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case(expr: str, pairs: dict, other: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v) if v is not None else 'NULL'}" for k, v in pairs.items())
    return f"CASE {expr} {whens} ELSE {other} END"


WS = q(WHITESPACE)


def trim(x: str) -> str:
    return f"trim({x}, {WS})"


def rut(x: str) -> str:
    bare = f"ltrim(replace(replace({trim(x)}, '.', ''), '-', ''), {WS})"
    digits = f"regexp_extract({bare}, '^([0-9]+)(\\s|$)', 1)"
    return f"CASE WHEN {digits} <> '' THEN coalesce(nullif(ltrim({digits}, '0'), ''), '0') END"


def dv(x: str) -> str:
    return f"CASE WHEN regexp_full_match(upper({trim(x)}), '[0-9K]') THEN upper({trim(x)}) END"


def sex(x: str) -> str:
    return f"CASE WHEN upper({trim(x)}) IN ('MUJER', 'F') THEN 'F' WHEN upper({trim(x)}) IN ('VARON', 'VARÓN', 'M') THEN 'M' END"


def date(x: str) -> str:
    t = trim(x)
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]{{8}}') THEN CAST(try_strptime({t}, '%Y%m%d') AS DATE)"
        f" ELSE CAST(try_strptime(substr({t}, 1, 10), '%Y-%m-%d') AS DATE) END"
    )


def cut(x: str, n: int = 255) -> str:
    return f"nullif(substr({trim(x)}, 1, {n}), '')"


def phone(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return f"CASE length({d}) WHEN 8 THEN '9' || {d} WHEN 9 THEN {d} END"


def region(x: str) -> str:
    full = case(trim(x), TRUNCATED_REGIONS, trim(x))
    return f"CASE WHEN ({full}) IN {in_list(VALID_REGIONS)} THEN {full} END"


def spaced(x: str) -> str:
    return trim(f"regexp_replace({trim(f"regexp_replace({x}, ' +', ' ', 'g')")}, '\\.([A-Za-zÀ-ÿ])', '. \\1', 'g')")


def usable(x: str) -> str:
    return (
        f"(length({trim(x)}) >= 3 AND NOT regexp_matches({trim(x)}, '[0-9]')"
        f" AND NOT contains({q(BAD_FIRST_CHARS)}, substr({trim(x)}, 1, 1)))"
    )


def fold(x: str) -> str:
    return f"upper(strip_accents({x}))"


def with_commune(corrections=None) -> str:
    """raw_clients with the cleaned commune as `limpa`, one step per level."""
    corrections = corrections or COMMUNE_CORRECTIONS
    return f"""(SELECT * EXCLUDE (s_, v_, k_), CASE WHEN {usable('comuna')} AND length(v_) >= 3 THEN CASE
        WHEN k_ IN {in_list(corrections)} THEN {case('k_', corrections, 'NULL')}
        WHEN k_ IN {in_list(REGION_PREFIXES)} THEN NULL ELSE v_ END END AS limpa
      FROM (SELECT *, {fold('v_')} AS k_
      FROM (SELECT *, CASE WHEN length(rtrim(s_, '.')) >= 3 THEN rtrim(s_, '.') ELSE s_ END AS v_
      FROM (SELECT *, {spaced(trim('comuna'))} AS s_ FROM raw_clients))))"""


def pct(part: str, total: str, zero: str) -> str:
    ratio = f"(CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100)"
    return f"CASE WHEN {total} = 0 THEN {q(zero)} ELSE CAST(round_even({ratio}, 1) AS VARCHAR) || '%' END"


def code(s="sucesso", t="telefone_validado", m="email_validado", x="erro") -> str:
    ok = f"regexp_full_match({trim(s)}, '0*1')"
    err = f"lower({trim(x)})"

    def any_of(fragments):
        return "(" + " OR ".join(f"contains({err}, {q(f)})" for f in fragments) + ")"

    return (
        f"CAST(CASE WHEN {ok} AND {trim(t)} <> '' AND ({phone(t)}) IS NULL THEN 8"
        f" WHEN {ok} AND {trim(t)} <> '' AND {trim(m)} <> '' THEN 1 WHEN {ok} AND {trim(t)} <> '' THEN 6"
        f" WHEN {ok} AND {trim(m)} <> '' THEN 7 WHEN {ok} THEN 2"
        f" WHEN {any_of(REGISTERED_USER_ERRORS)} THEN 3 WHEN {any_of(CONNECTION_ERRORS)} THEN 4 ELSE 5 END AS INT)"
    )


def status(c: str) -> str:
    return (
        f"CASE WHEN {c} IN (1, 6) THEN 'telefone_validado' WHEN {c} IN (4, 5) THEN 'pendente'"
        f" ELSE 'telefone_nao_validado' END"
    )


def first(table: str, keys: str, order: str, where: str = "TRUE", desc: bool = False) -> str:
    """Rows ranked first per key."""
    how = ", ".join(f"{o.strip()} DESC" for o in order.split(",")) if desc else order
    return (
        f"(SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {how}) AS rn_"
        f" FROM {table} WHERE {where}) WHERE rn_ = 1)"
    )


PH = "line_no, pk, sk"
CUSTOMERS = f"""(SELECT line_no, {rut('rut')} AS rut, {dv('dv')} AS dv, {cut('nombre')} AS nome, {sex('sexo')} AS sexo,
  {date('fecha_nac')} AS data_nascimento, {cut('direccion')} AS direccion, {cut('comuna', 100)} AS comuna,
  {cut('region', 100)} AS region FROM raw_clients)"""
CLEANED = f"""(SELECT line_no, {rut('rut')} AS rut, {region('region')} AS region, limpa AS comuna FROM {with_commune()})"""
CLEAN_FILE = f"""(SELECT line_no, rut, dv, nombre, sexo,
  CASE WHEN ({rut('rut')}) IS NULL THEN direccion ELSE coalesce({cut('direccion')}, '') END AS direccion,
  CASE WHEN ({rut('rut')}) IS NULL THEN comuna ELSE coalesce(limpa, '') END AS comuna,
  CASE WHEN ({rut('rut')}) IS NULL THEN region ELSE coalesce({region('region')}, '') END AS region,
  fecha_nac FROM {with_commune()})"""
PHONE_LINES = f"""(SELECT {rut('rut')} AS rut, {phone('celular')} AS valor, line_no, pk, sk FROM raw_phones)"""
EMAIL_LINES = f"""(SELECT {rut('rut')} AS rut, nullif({trim('email')}, '') AS valor, line_no FROM raw_emails)"""
USABLE = "rut IS NOT NULL AND valor IS NOT NULL"


def resolved(lines: str, order: str) -> str:
    return f"(SELECT l.*, c.id AS cliente_id FROM {first(lines, 'rut, valor', order, USABLE)} l JOIN clients c ON c.rut = l.rut)"


def new_contacts(lines: str, order: str, column: str, stored: str) -> str:
    cols = ", ".join(f"r.{o.strip()}" for o in order.split(","))
    return f"""SELECT r.cliente_id, r.valor AS {column}, 'enriquecimento' AS origem, {cols} FROM {resolved(lines, order)} r
      WHERE NOT EXISTS (SELECT 1 FROM {stored} s WHERE s.cliente_id = r.cliente_id AND s.{column} = r.valor AND s.origem = 'enriquecimento')"""


RESULTS = f"(SELECT {trim('rut')} AS rut, line_no, {code()} AS code FROM macro_result WHERE {trim('rut')} <> '')"


def outcomes(order: str = "line_no", lines: str = RESULTS) -> str:
    return f"""(SELECT rut, resposta_id, {status('resposta_id')} AS status FROM (
      SELECT rut, coalesce(arg_min(code, {order}) FILTER (WHERE code IN {FINAL}), arg_max(code, {order})) AS resposta_id
      FROM {lines} GROUP BY rut))"""


CLIENT_OUTCOMES = f"(SELECT c.id AS cliente_id, o.* FROM {outcomes()} o JOIN clients c ON c.rut = o.rut)"


def apply_results(state: str) -> str:
    opened = "s.status IN ('pendente', 'processando')"
    return f"""
      SELECT coalesce(s.id, m.top + 1 + o.cliente_id) AS id,
        coalesce(s.cliente_id, o.cliente_id) AS cliente_id,
        CASE WHEN s.id IS NULL OR (o.rut IS NOT NULL AND {opened}) THEN o.status ELSE s.status END AS status,
        CASE WHEN s.id IS NULL OR (o.rut IS NOT NULL AND {opened}) THEN o.resposta_id ELSE s.resposta_id END AS resposta_id,
        s.telefone_id, s.email_id, coalesce(s.extraido, 0) AS extraido, s.data_extracao,
        CASE WHEN o.rut IS NOT NULL THEN {NOW} ELSE s.data_update END AS data_update
      FROM {state} s FULL JOIN {CLIENT_OUTCOMES} o ON o.cliente_id = s.cliente_id
      CROSS JOIN (SELECT max(id) AS top FROM {state}) m"""


CLOSED = "(SELECT * FROM work_state_u WHERE status <> 'pendente')"
DAY = """(SELECT CAST(w.data_update AS DATE) AS dia, w.status, r.mensagem, count(*) AS qtd
  FROM work_state w LEFT JOIN respostas r ON r.id = w.resposta_id
  WHERE w.status NOT IN ('pendente', 'processando') GROUP BY ALL)"""
STATUS = "(SELECT status, count(*) AS qtd FROM work_state GROUP BY status)"
STAGING = """(SELECT arquivo, data_carga, clientes_no_banco, processados, pendentes, com_telefone, sem_telefone FROM (
  SELECT i.id, i.filename AS arquivo, CAST(i.created_at AS DATE) AS data_carga, count(DISTINCT c.id) AS clientes_no_banco,
    count(CASE WHEN w.status NOT IN ('pendente', 'processando') THEN 1 END) AS processados,
    count(CASE WHEN w.status = 'pendente' THEN 1 END) AS pendentes,
    count(CASE WHEN w.status = 'telefone_validado' THEN 1 END) AS com_telefone,
    count(CASE WHEN w.status = 'telefone_nao_validado' THEN 1 END) AS sem_telefone
  FROM imports i JOIN clients c ON c.staging_id = i.id JOIN work_state w ON w.cliente_id = c.id
  WHERE i.status = 'completed' GROUP BY i.id, i.filename, i.created_at))"""


def summary(rows: str, active: str, inactive: str) -> str:
    return f"""(SELECT *, {pct('ativos', 'total', '-')} AS pct_ativos, {pct('inativos', 'total', '-')} AS pct_inativos FROM (
      SELECT CAST(dia AS VARCHAR) AS dia, CAST(sum(qtd) AS BIGINT) AS total,
        CAST(coalesce(sum(CASE WHEN status IN {active} THEN qtd END), 0) AS BIGINT) AS ativos,
        CAST(coalesce(sum(CASE WHEN status IN {inactive} THEN qtd END), 0) AS BIGINT) AS inativos
      FROM {rows} WHERE dia IS NOT NULL GROUP BY 1))"""


def total_row(rows: str) -> str:
    return f"""(SELECT *, {pct('ativos', 'total', '0%')} AS pct_ativos, {pct('inativos', 'total', '0%')} AS pct_inativos FROM (
      SELECT 'Total' AS dia, CAST(sum(total) AS BIGINT) AS total, CAST(sum(ativos) AS BIGINT) AS ativos,
        CAST(sum(inativos) AS BIGINT) AS inativos FROM {rows} HAVING count(*) > 1))"""


def both(rows: str) -> str:
    return f"SELECT * FROM {rows} UNION ALL BY NAME SELECT * FROM {total_row(rows)}"


CONTACT = ("('telefone_validado')", "('telefone_nao_validado')")
CONTRACT = ("('consolidado')", "('excluido', 'reprocessar')")
LATEST = f"""(SELECT v.normalized_rut, i.filename FROM {first('staging_rows', 'normalized_rut', 'id', "validation_status = 'valid'", desc=True)} v
  JOIN imports i ON i.id = v.staging_id)"""
CONTRACT_ROLLUP = f"""(SELECT CAST(m.data_update AS DATE) AS dia, m.status, r.mensagem, r.status AS resposta_status, d.nome AS empresa,
    coalesce(co.fornecedor, 'fornecedor2') AS fornecedor,
    CASE WHEN m.data_extracao IS NULL THEN 'Dados históricos' ELSE coalesce(la.filename, 'operacional') END AS arquivo_origem,
    count(*) AS qtd
  FROM contract_state m LEFT JOIN contract_respostas r ON r.id = m.resposta_id LEFT JOIN companies d ON d.id = m.distribuidora_id
  LEFT JOIN suppliers co ON co.cliente_id = m.cliente_id LEFT JOIN contract_clients cl ON cl.id = m.cliente_id
  LEFT JOIN {LATEST} la ON la.normalized_rut = cl.cpf
  WHERE m.status <> 'pendente' AND m.resposta_id IS NOT NULL GROUP BY ALL)"""
ORIGIN = f"""(SELECT w.*, CASE WHEN w.data_extracao IS NULL THEN 'Dados históricos' ELSE coalesce(la.filename, 'operacional') END AS arquivo_origem
  FROM work_state w LEFT JOIN clients c ON c.id = w.cliente_id LEFT JOIN {LATEST} la ON la.normalized_rut = c.rut)"""


def distribution(rows: str, where: str = "TRUE") -> str:
    return f"SELECT {trim('mensagem')} AS mensagem, CAST(sum(qtd) AS BIGINT) AS quantidade FROM {rows} WHERE mensagem IS NOT NULL AND {where} GROUP BY 1"


REPORT_ROWS = f"""(SELECT rut, CASE WHEN region IN {in_list(REPORT_REGIONS)} THEN region END AS region,
  CASE WHEN {usable('comuna')} THEN comuna END AS comuna FROM {first(CLEANED, 'rut', 'line_no', 'rut IS NOT NULL')})"""
BY_COMMUNE = f"""(SELECT coalesce(region, '(sem região)') AS region, coalesce(comuna, '(sem cidade)') AS comuna, count(*) AS total
  FROM {REPORT_ROWS} GROUP BY 1, 2)"""
PENDING = f"""(SELECT * FROM {first('(SELECT w.*, c.rut FROM work_state w JOIN clients c ON c.id = w.cliente_id)', 'rut', 'data_update, id', "status = 'pendente'", desc=True)})"""
ADDRESS = f"(SELECT cliente_id, direccion, comuna, region FROM {first('addresses', 'cliente_id', 'id')})"


def slots(table: str, value: str, prefix: str, k: int, order: str) -> str:
    cols = ", ".join(f"max(CASE WHEN rn = {n} THEN {value} END) AS {prefix}_{n}" for n in range(1, k + 1))
    return f"""(SELECT cliente_id, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id
      ORDER BY CASE origem WHEN 'validado' THEN 0 ELSE 1 END, {order}) AS rn FROM {table}) GROUP BY cliente_id)"""


PHONE_SLOTS = slots("phones", "numero", "telefone", 5, PH)
EMAIL_SLOTS = slots("emails", "endereco", "email", 2, "id")
AGE = """coalesce(CAST(2026 - year(data_nascimento) - CAST(228 < month(data_nascimento) * 100 + day(data_nascimento) AS INT) AS VARCHAR), '')"""
PRINTED = "coalesce(strftime(data_nascimento, '%d/%m/%Y'), '')"
_EXPORT = {
    "RUT": "c.rut", "DV": "c.dv", "NOME": "c.nome", "SEXO": "c.sexo", "DATA_NASCIMENTO": PRINTED, "IDADE": AGE,
    "DIRECCION": "a.direccion", "COMUNA": "a.comuna", "REGION": "a.region",
}
EXPORT = f"""SELECT {', '.join(f"coalesce({_EXPORT.get(c, c)}, '') AS {c}" for c in EXPORT_FILE)}
  FROM work_state_u w LEFT JOIN clients c ON c.id = w.cliente_id LEFT JOIN {ADDRESS} a ON a.cliente_id = w.cliente_id
  LEFT JOIN {PHONE_SLOTS} p ON p.cliente_id = w.cliente_id LEFT JOIN {EMAIL_SLOTS} e ON e.cliente_id = w.cliente_id
  WHERE w.status = 'telefone_validado' AND w.extraido = 0"""


def tels(sep: str) -> str:
    return f"""(SELECT cliente_id, string_agg(numero, '{sep}' ORDER BY pos, numero) AS telefones
      FROM (SELECT cliente_id, numero, min(line_no) AS pos FROM phones GROUP BY 1, 2) GROUP BY cliente_id)"""


FULL_ADDRESS = """endereco || ', ' || coalesce(numero, '') || ' ' || coalesce(complemento, '') || ', ' || coalesce(bairro, '')
  || ', ' || coalesce(cidade, '') || ' - ' || coalesce(uf, '') || ' CEP: ' || coalesce(cep, '')"""
CONTRACT_REPORT = f"""(SELECT DISTINCT cu.uc AS uc_ativa, c.cpf, c.nome, t.telefones, {FULL_ADDRESS.replace('numero', 'e.numero')} AS endereco_completo,
    d.nome AS distribuidora, r.mensagem AS retorno
  FROM contract_state s JOIN contract_clients c ON c.id = s.cliente_id LEFT JOIN units cu ON cu.id = s.cliente_uc_id
  LEFT JOIN {tels('; ')} t ON t.cliente_id = c.id
  LEFT JOIN contract_addresses e ON e.cliente_id = c.id AND e.id = (SELECT min(x.id) FROM contract_addresses x WHERE x.cliente_id = c.id)
  LEFT JOIN companies d ON d.id = s.distribuidora_id JOIN contract_respostas r ON r.id = s.resposta_id
  WHERE r.mensagem = 'Titularidade confirmada com contrato ativo' AND s.status = 'consolidado')"""
WITH_UNIT = """(SELECT s.*, cu.uc FROM contract_state s JOIN units cu ON cu.id = coalesce(s.cliente_uc_id,
  (SELECT min(u.id) FROM units u WHERE u.cliente_id = s.cliente_id AND u.distribuidora_id = s.distribuidora_id)))"""


def batch(n: int, suppliers: bool = True) -> str:
    f = "coalesce(co.fornecedor, 'fornecedor2')" if suppliers else "'fornecedor2'"
    rank = f"{f} = 'fornecedor2' DESC, " if suppliers else ""
    join = "LEFT JOIN suppliers co ON co.cliente_id = s.cliente_id" if suppliers else ""
    return f"""(SELECT s.id AS macro_id, c.cpf, s.uc AS "codigo cliente", d.nome AS empresa, s.status AS status_atual, {f} AS fornecedor
      FROM {WITH_UNIT} s JOIN contract_clients c ON c.id = s.cliente_id JOIN companies d ON d.id = s.distribuidora_id {join}
      WHERE s.status IN ('pendente', 'reprocessar')
      ORDER BY s.status = 'pendente' DESC, {rank}s.data_update, s.id{', fornecedor' if suppliers else ''} LIMIT {n})"""


HISTORY = "(SELECT DISTINCT cpf, uc, distribuidora_id FROM history WHERE resposta_id = '3')"


def by_history(rows: str) -> str:
    return f"""(SELECT r.*, h.uc, CASE WHEN h.uc IS NULL THEN 'sem_historico'
        WHEN count(*) OVER (PARTITION BY r.id) > 1 THEN 'historico_multiplo' ELSE 'historico_unico' END AS origem_uc
      FROM {rows} r LEFT JOIN {HISTORY} h ON h.cpf = r.cpf AND h.distribuidora_id = CAST(r.distribuidora_id AS VARCHAR))"""


CONFIRMED = f"""(SELECT s.id, s.cliente_uc_id, s.distribuidora_id, c.cpf, c.nome, d.nome AS distribuidora, e.endereco, e.numero, e.bairro,
    e.cidade, e.uf, e.cep, t.telefones
  FROM contract_state s JOIN contract_clients c ON c.id = s.cliente_id JOIN companies d ON d.id = s.distribuidora_id
  LEFT JOIN contract_addresses e ON e.cliente_id = c.id AND e.distribuidora_id = s.distribuidora_id
  LEFT JOIN {tels(';')} t ON t.cliente_id = c.id WHERE s.resposta_id = 3)"""
PROV = "cpf, nome, uc, distribuidora, endereco, numero, bairro, cidade, uf, cep, telefones, origem_uc"
_LEGACY = {str(k): str(k) for k, _, _ in CONTRACT_OUTCOMES}


def body(catalogue: bool) -> str:
    t = "trim(coalesce(body, ''))"
    c = f"""CASE WHEN starts_with({t}, '{{') THEN try_cast(json_extract_string({t}, '$.CodigoRetorno') AS INT) END"""
    states = {i: CATALOGUE_STATUS[s] for i, _, s in CONTRACT_OUTCOMES}
    st = "CASE c " + " ".join(f"WHEN {i} THEN {q(s)}" for i, s in states.items()) + " END"
    rules = " ".join(f"WHEN contains(lower({t}), {q(f)}) THEN {i}" for f, i, _ in BODY_TEXT_RULES)
    rid = f"CASE WHEN {t} = '' THEN 6 WHEN c BETWEEN 0 AND 11 THEN c {rules} ELSE 11 END"
    sta = f"CASE WHEN {t} = '' THEN 'pendente' WHEN c BETWEEN 0 AND 11 THEN {st} ELSE 'reprocessar' END"
    return f"SELECT event_id, CAST({rid} AS INT) AS resposta_id, {sta} AS status FROM (SELECT *, {c} AS c FROM legacy_body)"


ERROR_WORDS = "|".join(REQUEST_ERROR_KEYWORDS)
STAGED = f"""(SELECT r.line_no, r.rut AS raw_rut, r.nombre AS raw_nome, {rut('r.rut')} AS normalized_rut, {dv('r.dv')} AS normalized_dv FROM raw_clients r)"""
KNOWN_F = "(SELECT rut FROM clients WHERE sexo = 'F')"
MESSAGE = f"""CASE WHEN trim(raw_rut) = '' THEN 'blank key' WHEN normalized_rut IS NULL THEN 'key is not numeric'
  WHEN length(normalized_rut) > 8 THEN 'key is too long' WHEN normalized_rut IN {KNOWN_F} THEN 'key already stored'
  WHEN line_no > min(line_no) OVER (PARTITION BY normalized_rut) THEN 'key repeated in file' END"""


def import_counters(clients: str) -> str:
    return f"""SELECT CAST(count(*) AS BIGINT) AS lidos, count(CASE WHEN n.rut IS NULL THEN 1 END) AS ignorados,
      count(CASE WHEN length(n.rut) > 8 THEN 1 END) AS quarentena,
      count(DISTINCT CASE WHEN length(n.rut) <= 8 AND c.id IS NULL THEN n.rut END) AS clientes_inseridos,
      count(DISTINCT CASE WHEN length(n.rut) <= 8 AND (c.id IS NULL OR c.id NOT IN (SELECT cliente_id FROM addresses)) THEN n.rut END) AS enderecos_inseridos,
      count(CASE WHEN length(n.rut) <= 8 THEN 1 END) - count(DISTINCT CASE WHEN length(n.rut) <= 8 AND c.id IS NULL THEN n.rut END) AS duplicados
      FROM {CUSTOMERS} n LEFT JOIN {clients} c ON c.rut = n.rut"""


VALIDATED_PHONES = f"""(SELECT c.id AS cliente_id, {phone(trim('r.telefone_validado'))} AS numero, 'validado' AS origem, r.line_no
  FROM macro_result r JOIN clients c ON c.rut = {trim('r.rut')})"""
VALIDATED_EMAILS = f"""(SELECT c.id AS cliente_id, nullif({trim('r.email_validado')}, '') AS endereco, 'validado' AS origem, r.line_no
  FROM macro_result r JOIN clients c ON c.rut = {trim('r.rut')})"""


def not_stored(rows: str, column: str, stored: str) -> str:
    return f"""SELECT * FROM {first(rows, f'cliente_id, {column}', 'line_no', f'{column} IS NOT NULL')} r
      WHERE NOT EXISTS (SELECT 1 FROM {stored} s WHERE s.cliente_id = r.cliente_id AND s.{column} = r.{column} AND s.origem = r.origem)"""


def diff(check: str, base: str, rolled: str, key: str) -> str:
    return f"""SELECT '{check}' AS verificacao, count(*) AS n_chaves, CAST(coalesce(sum(a.n), 0) AS BIGINT) AS n_base,
      CAST(coalesce(sum(b.n), 0) AS BIGINT) AS n_rollup, count(CASE WHEN a.n IS NULL OR b.n IS NULL OR a.n <> b.n THEN 1 END) AS n_diff
      FROM (SELECT {key} AS k, sum(n) AS n FROM {base} GROUP BY 1) a
      FULL JOIN (SELECT {key} AS k, sum(n) AS n FROM {rolled} GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k"""


BASE5 = """(SELECT w.status, r.mensagem, CAST(w.data_update AS DATE) AS dia, count(*) AS n, 'todos' AS todos
  FROM work_state w LEFT JOIN respostas r ON r.id = w.resposta_id WHERE w.status <> 'pendente' AND w.resposta_id IS NOT NULL GROUP BY ALL)"""
ROLLED5 = f"(SELECT *, qtd AS n, 'todos' AS todos FROM {DAY})"
BASE6 = """(SELECT CAST(s.data_update AS DATE) AS dia, d.nome AS empresa, count(*) AS n
  FROM contract_state s JOIN companies d ON d.id = s.distribuidora_id LEFT JOIN suppliers co ON co.cliente_id = s.cliente_id
  WHERE s.status <> 'pendente' AND s.resposta_id IS NOT NULL GROUP BY ALL)"""
ROLLED6 = f"(SELECT *, qtd AS n FROM {CONTRACT_ROLLUP})"

_state_domain = "('pendente', 'processando', 'telefone_validado', 'telefone_nao_validado')"
_folded = {}
for _k, _v in COMMUNE_CORRECTIONS.items():
    _folded[_k.replace("Ñ", "N")] = _v

ORACLES: dict[str, str] = {
    # --- sources and sinks
    "s01_bulk_source": "SELECT rut, dv, nombre, sexo, direccion, comuna, region, fecha_nac FROM raw_clients",
    "s02_clean_source": f"SELECT rut, direccion, comuna, region FROM {CLEAN_FILE}",
    "s03_result_source": "SELECT rut, dv, telefone_validado, email_validado, sucesso, erro FROM macro_result",
    "s04_key_lookup": f"SELECT id, rut FROM clients WHERE rut IN (SELECT {rut('rut')} FROM raw_phones)",
    "s05_cleaned_file_sink": f"SELECT * EXCLUDE (line_no) FROM {CLEAN_FILE}",
    "s06_customer_export_sink": EXPORT,
    "s07_report_export_sink": f"""SELECT coalesce(uc_ativa, '') AS "UC Ativa", cpf AS "CPF", nome AS "Nome", coalesce(telefones, '') AS "Telefones",
      coalesce(endereco_completo, '') AS "Endereco Completo", coalesce(distribuidora, '') AS "Distribuidora", retorno AS "Retorno" FROM {CONTRACT_REPORT}""",
    "s08_batch_handoff": f"""SELECT (SELECT count(*) FROM {batch(2000)}) AS total, FALSE AS dry_run, macro_id, cpf, "codigo cliente", empresa, fornecedor FROM {batch(2000)}""",
    "s09_insert_ignore_clients": f"""SELECT (SELECT max(id) FROM clients WHERE sexo = 'F') + 1 + line_no AS id,
      rut, dv, nome, sexo, data_nascimento, 7 AS staging_id FROM {first(CUSTOMERS, 'rut', 'line_no', 'length(rut) <= 8')}
      WHERE rut NOT IN {KNOWN_F}""",
    "s09_insert_ignore_phones": new_contacts(PHONE_LINES, PH, "numero", "phones"),
    "s09_insert_ignore_emails": new_contacts(EMAIL_LINES, "line_no", "endereco", "emails"),
    "s09_insert_ignore_emails_collated": f"""SELECT cliente_id, valor AS endereco, 'enriquecimento' AS origem, line_no
      FROM {first(resolved(EMAIL_LINES, 'line_no'), 'cliente_id, lower(valor)', 'line_no')}""",
    "s10_state_upsert": apply_results(CLOSED),
    "s11_update_join": f"""SELECT c.id, c.rut, c.dv, CASE WHEN d.rut IS NULL THEN c.nome ELSE d.nome END AS nome,
      CASE WHEN d.rut IS NULL THEN c.sexo ELSE d.sexo END AS sexo, c.data_nascimento, c.staging_id
      FROM clients c LEFT JOIN {first(CUSTOMERS, 'rut', 'line_no', 'rut IS NOT NULL')} d ON d.rut = c.rut""",
    "s12_full_refresh": f"SELECT *, {NOW} AS atualizado_em FROM {DAY}",
    "s13_rollup_reader": f"SELECT * FROM {STAGING}",
    "s14_row_limited": "SELECT line_no, rut FROM raw_clients ORDER BY line_no LIMIT 1000",
    "s15_dry_run": import_counters("clients"),
    "s16_resume": "SELECT id, rut FROM clients WHERE rut NOT IN (SELECT rut FROM macro_result WHERE sucesso <> '')",
    "s17_history_source": f"SELECT * FROM {HISTORY}",
    # --- projections
    "p01_normalize_rut": f"SELECT line_no, {rut('rut')} AS rut FROM raw_clients",
    "p02_normalize_dv": f"SELECT line_no, {dv('dv')} AS dv FROM raw_clients",
    "p03_normalize_sex": f"SELECT line_no, {sex('sexo')} AS sexo FROM raw_clients",
    "p04_parse_date": f"SELECT line_no, {date('fecha_nac')} AS data_nascimento FROM raw_clients",
    "p05_trim_truncate": f"SELECT line_no, {cut('nombre', 12)} AS nome, {cut('direccion')} AS direccion, {cut('region', 100)} AS region FROM raw_clients",
    "p06_normalize_phone": f"SELECT line_no, pk, sk, {phone('celular')} AS numero FROM raw_phones",
    "p07_clean_region": f"SELECT line_no, {region('region')} AS region FROM raw_clients",
    "p08_clean_commune": f"SELECT line_no, limpa AS comuna FROM {with_commune()}",
    "p08_clean_commune_folded_keys": f"SELECT line_no, limpa AS comuna FROM {with_commune(_folded)}",
    "p09_fold_accents": f"SELECT line_no, {fold('comuna')} AS chave FROM raw_clients",
    "p10_normalize_spacing": f"SELECT line_no, {spaced('comuna')} AS comuna FROM raw_clients",
    "p11_trim_whitespace": f"SELECT line_no, {trim('rut')} AS rut, {trim('direccion')} AS direccion FROM raw_clients",
    "p12_age": f"SELECT id, {AGE} AS idade FROM clients",
    "p13_print_date": f"SELECT id, {PRINTED} AS data FROM clients",
    "p14_interpret_result": f"SELECT line_no, resposta_id, {status('resposta_id')} AS status FROM (SELECT line_no, {code()} AS resposta_id FROM macro_result)",
    "p15_interpret_body": body(False),
    "p15_interpret_body_catalogue": body(True),
    "p15_interpret_body_wide_ids": """SELECT event_id, CAST(250 + event_id % 60 AS INTEGER) AS resposta_id,
      CASE WHEN (250 + event_id % 60) % 2 = 0 THEN 'consolidado' ELSE 'excluido' END AS status FROM legacy_body""",
    "p16_catalogue_status": f"""SELECT s.id, {case('r.status', CATALOGUE_STATUS, "'reprocessar'")} AS estado
      FROM contract_state s LEFT JOIN contract_respostas r ON r.id = s.resposta_id""",
    "p17_status_label": f"SELECT id, {case('status', STATUS_LABELS, 'status')} AS rotulo FROM work_state",
    "p18_sentence_case": "SELECT event_id, upper(substr(trim(mensagem), 1, 1)) || lower(substr(trim(mensagem), 2)) AS mensagem FROM texts",
    "p19_request_error": f"""SELECT event_id, coalesce(upper(trim(Error)) NOT IN ('FALSO', 'FALSE', '0', ''), FALSE)
      OR regexp_matches(coalesce(mensagem, ''), '(?i){ERROR_WORDS}') OR regexp_matches(coalesce(mensagem, ''), '\\b5[0-9][0-9]\\b') AS erro FROM texts""",
    "p21_full_address": f"SELECT id, {FULL_ADDRESS} AS endereco_completo FROM contract_addresses",
    "p22_supplier_default": "SELECT c.id, coalesce(s.fornecedor, 'fornecedor2') AS fornecedor FROM contract_clients c LEFT JOIN suppliers s ON s.cliente_id = c.id",
    "p23_origin_file": """SELECT id, CASE WHEN data_extracao IS NULL THEN 'Dados históricos' ELSE coalesce(f, 'operacional') END AS arquivo_origem,
      CASE WHEN data_extracao IS NULL THEN 'Histórico' ELSE coalesce(f, 'desconhecido') END AS origem
      FROM (SELECT *, CASE WHEN id % 3 = 0 THEN 'f' || CAST(id % 4 AS VARCHAR) END AS f FROM work_state)""",
    "p24_percent_text": f"SELECT id, {pct('(id % 13)', '(id % 29)', '-')} AS pct FROM contract_clients",
    "p25_month_key": "SELECT id, strftime(data_update, '%Y-%m') AS mes, strftime(data_update, '%m/%Y') AS rotulo FROM work_state",
    "p26_write_coercion": f"SELECT * FROM (SELECT line_no, {rut('rut')} AS rut, {dv('dv')} AS dv FROM raw_clients) WHERE length(rut) <= 8",
    "p27_code_rename": "SELECT id, 'validado' AS origem FROM emails WHERE origem IN ('validado', 'enriquecimento')",
    "p28_short_file_name": "SELECT id, '2026-04-0' || (staging_id % 5 + 1) || '/carga_' || (staging_id % 20) || '.csv' AS arquivo FROM staging_rows",
    "p29_landed_fields": """SELECT line_no, rut, CASE WHEN sucesso = '1' THEN telefone_validado ELSE '' END AS telefone_validado,
      CASE WHEN sucesso = '1' THEN email_validado ELSE '' END AS email_validado, CASE WHEN sucesso = '1' THEN '1' ELSE '0' END AS sucesso,
      CASE WHEN sucesso = '1' THEN '' WHEN erro = '' THEN 'Erro ou retorno desconhecido' ELSE erro END AS erro FROM macro_result""",
    "p29_landed_pages": """SELECT line_no, CASE WHEN sucesso = '1' THEN telefone_validado ELSE '' END AS telefone_validado,
      CASE WHEN sucesso = '1' THEN email_validado ELSE '' END AS email_validado, CASE WHEN sucesso = '1' THEN '1' ELSE '0' END AS sucesso,
      CASE WHEN sucesso = '1' THEN '' ELSE 'La póliza nº ' || line_no || ' <no> existe' END AS erro FROM macro_result""",
    # --- filters
    "f01_rejected_rows": f"""SELECT line_no, rut, CASE WHEN trim(rut) = '' THEN 'blank key' WHEN n IS NULL THEN 'key is not numeric' ELSE 'key is too long' END AS reason
      FROM (SELECT *, {rut('rut')} AS n FROM raw_clients) WHERE n IS NULL OR length(n) > 8""",
    "f02_status_set": "SELECT id, status FROM work_state WHERE status NOT IN ('pendente', 'processando')",
    "f03_day_selection": f"SELECT * FROM {DAY} WHERE CAST(dia AS VARCHAR) LIKE '1997-05%' OR dia = DATE '1998-10-03'",
    "f03_month_without_days": f"SELECT * FROM {DAY}",
    "f04_dimension_filters": f"""SELECT * FROM {CONTRACT_ROLLUP} WHERE fornecedor = 'fornecedor1'
      AND arquivo_origem IN ('Dados históricos', 'carga_3.csv') AND empresa = 'AFRICA'""",
    "f05_not_consumed": "SELECT id, cliente_id FROM work_state WHERE status = 'telefone_validado' AND extraido = 0",
    "f05_not_consumed_contracts": "SELECT id, cliente_id FROM contract_state WHERE status = 'consolidado' AND extraido = 0",
    "f06_pages": "SELECT id, cliente_id, (row_number() OVER (ORDER BY id) - 1) // 500 AS pagina FROM contract_state WHERE status = 'consolidado' AND extraido = 0",
    "f07_incomplete_rows": "SELECT line_no FROM macro_result WHERE sucesso = ''",
    "f08_report_validation": f"""SELECT line_no, CASE WHEN {trim('region')} IN {in_list(REPORT_REGIONS)} THEN {trim('region')} END AS region,
      CASE WHEN {usable('comuna')} THEN {trim('comuna')} END AS comuna FROM raw_clients""",
    "f09_reportable_messages": f"SELECT event_id, mensagem FROM texts WHERE upper(trim(mensagem)) NOT IN {in_list(EXCLUDED_MESSAGES)}",
    "f10_unresolved": "SELECT id, status FROM work_state WHERE status <> 'pendente' AND resposta_id IS NULL",
    # --- joins
    "j01_contact_clients": f"SELECT * FROM {resolved(PHONE_LINES, PH)}",
    "j01_email_clients": f"SELECT * FROM {resolved(EMAIL_LINES, 'line_no')}",
    "j02_result_clients": "SELECT r.line_no, r.rut, c.id AS cliente_id FROM macro_result r JOIN clients c ON c.rut = trim(r.rut)",
    "j03_state_client": "SELECT w.id, w.cliente_id, w.status, c.rut, c.dv, c.nome FROM work_state w JOIN clients c ON c.id = w.cliente_id",
    "j04_finished_contacts": """SELECT w.id, c.rut, c.dv, c.nome, p.numero AS telefone_extraido, e.endereco AS email_extraido, w.status, w.data_update
      FROM work_state w JOIN clients c ON c.id = w.cliente_id LEFT JOIN linked_phones p ON p.id = w.telefone_id LEFT JOIN emails e ON e.id = w.email_id
      WHERE w.status IN ('telefone_validado', 'telefone_nao_validado')""",
    "j04_finished_contacts_created": """SELECT w.id, c.rut, c.dv, c.nome, p.numero AS telefone_extraido, e.endereco AS email_extraido, w.status,
        w.data_update - INTERVAL 1 DAY AS data_criacao, w.data_update
      FROM work_state w JOIN clients c ON c.id = w.cliente_id LEFT JOIN linked_phones p ON p.id = w.telefone_id LEFT JOIN emails e ON e.id = w.email_id
      WHERE w.status IN ('telefone_validado', 'telefone_nao_validado')""",
    "j05_client_contacts": """SELECT c.id AS cliente_id, c.rut, c.dv, c.nome, c.sexo, c.data_nascimento, x.tipo, x.valor, x.comuna, x.region, x.origem
      FROM clients c LEFT JOIN (
        SELECT cliente_id, 'endereco' AS tipo, direccion AS valor, comuna, region, NULL AS origem FROM addresses
        UNION ALL SELECT cliente_id, 'telefone', numero, NULL, NULL, origem FROM phones
        UNION ALL SELECT cliente_id, 'email', endereco, NULL, NULL, origem FROM emails) x ON x.cliente_id = c.id""",
    "j06_state_catalogue": "SELECT w.id, w.resposta_id, r.mensagem FROM work_state w LEFT JOIN respostas r ON r.id = w.resposta_id",
    "j07_import_client_state": """SELECT w.id, w.cliente_id, w.status, c.staging_id, i.filename
      FROM imports i JOIN clients c ON c.staging_id = i.id JOIN work_state w ON w.cliente_id = c.id""",
    "j08_unit_or_first": f"SELECT id, cliente_id, uc FROM {WITH_UNIT}",
    "j09_optional_supplier": "SELECT s.id, s.cliente_id, coalesce(co.fornecedor, 'fornecedor2') AS fornecedor FROM contract_state s LEFT JOIN suppliers co ON co.cliente_id = s.cliente_id",
    "j09_without_supplier_table": "SELECT id, cliente_id, 'fornecedor2' AS fornecedor FROM contract_state",
    "j10_first_address": """SELECT c.id AS cliente_id, a.direccion, a.comuna, a.region FROM clients c
      LEFT JOIN addresses a ON a.cliente_id = c.id AND a.id = (SELECT min(x.id) FROM addresses x WHERE x.cliente_id = c.id)""",
    "j11_history_resolve": f"""SELECT * FROM {by_history('''(SELECT s.id, s.cliente_id, s.distribuidora_id, c.cpf FROM contract_state s
      JOIN contract_clients c ON c.id = s.cliente_id WHERE s.resposta_id = 3 AND s.cliente_uc_id IS NULL)''')}""",
    "j12_latest_file_enrichment": f"SELECT o.id, o.status, r.mensagem, o.arquivo_origem FROM {ORIGIN} o LEFT JOIN respostas r ON r.id = o.resposta_id",
    "j13_clients_of_selection": "SELECT id, rut, nome FROM clients WHERE id IN (SELECT cliente_id FROM work_state_u WHERE status = 'telefone_validado' AND extraido = 0)",
    "j14_clients_without_email": "SELECT id AS cliente_id, rut FROM clients WHERE id NOT IN (SELECT cliente_id FROM emails)",
    "j15_two_key_join": """SELECT s.id, s.cliente_id, s.distribuidora_id, e.endereco, e.cep FROM contract_state s
      LEFT JOIN contract_addresses e ON e.cliente_id = s.cliente_id AND e.distribuidora_id = s.distribuidora_id""",
    # --- aggregations
    "a01_day_status_message": f"SELECT * FROM {DAY}",
    "a02_status_distribution": f"SELECT * FROM {STATUS}",
    "a03_import_statistics": f"SELECT * FROM {STAGING}",
    "a04_daily_summary": f"SELECT * FROM {summary(DAY, *CONTACT)}",
    "a05_summary_with_total": both(summary(DAY, *CONTACT)),
    "a05_single_day_has_no_total": f"SELECT * FROM {summary(f'(SELECT * FROM {DAY} WHERE dia = (SELECT min(dia) FROM {DAY}))', *CONTACT)}",
    "a06_message_distribution": distribution(DAY),
    "a06_contract_message_distribution": distribution(CONTRACT_ROLLUP, "resposta_status <> 'pendente'"),
    "a07_status_as_messages": f"SELECT status AS mensagem, qtd AS quantidade FROM {STATUS}",
    "a08_info": f"SELECT CAST(sum(qtd) AS BIGINT) AS processados, count(DISTINCT dia) AS dias FROM {DAY}",
    "a09_customers_by_commune": f"SELECT * FROM {BY_COMMUNE}",
    "a10_customers_by_region": f"SELECT coalesce(region, '(sem região)') AS region, count(*) AS total FROM {REPORT_ROWS} GROUP BY 1",
    "a11_report_summary": f"""SELECT unnest(['Total clientes únicos', 'Cidades (comunas)', 'Regiões (inc. sem região)', 'Arquivo base', 'Data de geração']) AS informacao,
      unnest([CAST(sum(total) AS VARCHAR), CAST(count(*) AS VARCHAR), CAST(count(DISTINCT region) AS VARCHAR), 'clientes.txt', '07/04/2026 12:00:00']) AS valor FROM {BY_COMMUNE}""",
    "a12_phone_text": f"SELECT cliente_id, 0 AS parte, telefones FROM {tels(';')}",
    "a12_phone_rows": """SELECT cliente_id, row_number() OVER (PARTITION BY cliente_id ORDER BY first_line, numero) AS posicao, numero
      FROM (SELECT cliente_id, numero, min(line_no) AS first_line FROM phones WHERE numero IS NOT NULL GROUP BY 1, 2)""",
    "a13_contract_report": f"SELECT * FROM {CONTRACT_REPORT}",
    "a14_batch_composition": f"SELECT status_atual, fornecedor, count(*) AS qtd FROM {batch(2000)} GROUP BY 1, 2",
    "a15_import_counters": import_counters("(SELECT * FROM clients WHERE sexo = 'F')"),
    "a15_contact_counters": f"""SELECT count(*) AS lidos, count(DISTINCT CASE WHEN k THEN l.rut || '/' || valor END) AS inseridos,
      count(CASE WHEN {USABLE.replace('rut', 'l.rut')} AND c.id IS NOT NULL THEN 1 END) - count(DISTINCT CASE WHEN k THEN l.rut || '/' || valor END) AS duplicados,
      count(CASE WHEN {USABLE.replace('rut', 'l.rut')} AND c.id IS NULL THEN 1 END) AS sem_cliente,
      count(CASE WHEN l.rut IS NULL OR valor IS NULL THEN 1 END) AS invalidos
      FROM (SELECT l.*, EXISTS (SELECT 1 FROM clients c WHERE c.rut = l.rut) AND valor IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM phones p JOIN clients c ON c.id = p.cliente_id WHERE c.rut = l.rut AND p.numero = l.valor AND p.origem = 'enriquecimento') AS k
        FROM {PHONE_LINES} l) l LEFT JOIN clients c ON c.rut = l.rut""",
    "a16_cleaning_counters": f"""SELECT count(*) AS total, count(CASE WHEN k IS NULL THEN 1 END) AS sem_rut,
      count(CASE WHEN k IS NOT NULL AND r0 <> '' AND r1 <> r0 THEN 1 END) AS region_expandida,
      count(CASE WHEN k IS NOT NULL AND r0 <> '' AND r1 IS NULL THEN 1 END) AS region_nulificada,
      count(CASE WHEN k IS NOT NULL AND c0 <> '' AND c1 IS NULL THEN 1 END) AS comuna_nulificada
      FROM (SELECT {rut('rut')} AS k, {trim('region')} AS r0, {region('region')} AS r1, {trim('comuna')} AS c0, limpa AS c1 FROM {with_commune()})""",
    "a17_message_histogram": f"""SELECT upper(substr(t, 1, 1)) || lower(substr(t, 2)) AS mensagem, n AS quantidade FROM (
      SELECT trim(mensagem) AS t, count(*) AS n FROM texts WHERE upper(trim(mensagem)) NOT IN {in_list(EXCLUDED_MESSAGES)} GROUP BY 1)""",
    "a18_history_counts": f"SELECT count(*) AS combos, count(DISTINCT cpf) AS cpfs FROM {HISTORY}",
    "a19_file_statistics": f"""SELECT arquivo, CAST(CAST(data_carga AS DATE) AS VARCHAR) AS data_carga, cpfs_no_arquivo, ucs_ineditas, combos_processadas,
      greatest(ucs_ineditas - combos_processadas, 0) AS combos_pendentes, coalesce(combos_ativas, 0) AS combos_ativas,
      {pct('coalesce(combos_ativas, 0)', 'combos_processadas', '-')} AS pct_combos_ativas, 0 AS combos_inativas,
      {pct('0', 'combos_processadas', '-')} AS pct_combos_inativas FROM file_stats""",
    "a20_staging_state": "SELECT staging_id, validation_status, count(CASE WHEN processed_at IS NULL THEN 1 END) AS pendentes, count(*) AS total FROM staging_rows GROUP BY 1, 2",
    "a21_table_profile": " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS linhas FROM {t}" for t in TABLES),
    "a22_result_counters": f"""SELECT count(c.id) AS ok, count(*) - count(c.id) AS skip,
      count(CASE WHEN c.id IS NOT NULL THEN {phone('r.telefone_validado')} END) AS telefones,
      count(CASE WHEN c.id IS NOT NULL THEN nullif(trim(r.email_validado), '') END) AS emails, count(DISTINCT c.id) AS clientes
      FROM macro_result r LEFT JOIN clients c ON c.rut = trim(r.rut)""",
    # --- windows and ranks
    "w01_latest_pending": f"SELECT id, cliente_id, rut, data_update FROM {PENDING}",
    "w02_latest_file": f"SELECT * FROM {LATEST}",
    "w03_contact_slots": f"SELECT * FROM {PHONE_SLOTS}",
    "w03_email_slots": f"SELECT * FROM {EMAIL_SLOTS}",
    "w04_first_row_per_key": f"SELECT rut, line_no, dv, nome, sexo, data_nascimento FROM {first(CUSTOMERS, 'rut', 'line_no', 'rut IS NOT NULL')}",
    "w05_assign_ids": "SELECT line_no, rut, row_number() OVER (ORDER BY line_no) AS id FROM raw_clients",
    "w06_first_address": f"SELECT * FROM {ADDRESS}",
    # --- sorts and limits
    "t01_fifo_batch": f"SELECT id, cliente_id, rut, data_update FROM {PENDING} ORDER BY data_update, id LIMIT 500",
    "t01_default_batch": f"SELECT id, rut FROM {PENDING} ORDER BY data_update, id LIMIT 2000",
    "t02_id_batch": "SELECT w.id, w.cliente_id, c.rut, c.dv FROM work_state w JOIN clients c ON c.id = w.cliente_id WHERE w.status = 'pendente' ORDER BY w.id LIMIT 500",
    "t03_priority_batch": f"SELECT * FROM {batch(2000)}",
    "t03_priority_batch_no_suppliers": f"SELECT * FROM {batch(500, suppliers=False)}",
    "t04_top_files": f"SELECT arquivo_origem, count(*) AS quantidade FROM {ORIGIN} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "t05_day_options": f"SELECT DISTINCT dia FROM {DAY}",
    "t05_month_options": f"SELECT DISTINCT strftime(dia, '%Y-%m') AS value, strftime(dia, '%m/%Y') AS label FROM {DAY}",
    "t06_sorted_rollup": f"SELECT * FROM {DAY} ORDER BY dia DESC, status, mensagem",
    # --- set operations
    "u01_provenance_union": f"""SELECT {PROV} FROM (SELECT x.*, u.uc, 'cliente_uc_id' AS origem_uc FROM {CONFIRMED} x JOIN units u ON u.id = x.cliente_uc_id)
      UNION ALL SELECT {PROV} FROM {by_history(f'(SELECT * FROM {CONFIRMED} WHERE cliente_uc_id IS NULL)')}""",
    "u01_provenance_phones": """SELECT cliente_id, row_number() OVER (PARTITION BY cliente_id ORDER BY first_line, numero) AS posicao, numero
      FROM (SELECT cliente_id, numero, min(line_no) AS first_line FROM phones WHERE numero IS NOT NULL
        AND cliente_id IN (SELECT cliente_id FROM contract_state WHERE resposta_id = 3) GROUP BY 1, 2)""",
    "u02_total_row": f"SELECT * FROM {total_row(summary(CONTRACT_ROLLUP, *CONTRACT))}",
    "u03_distinct_history": f"SELECT * FROM {HISTORY}",
    "u04_multi_file_precedence": f"""SELECT * FROM {outcomes('o', f'''(SELECT rut, {code()} AS code,
      line_no + 1000000000 * CASE sucesso WHEN '0' THEN 0 WHEN '1' THEN 1 ELSE 2 END AS o FROM macro_result)''')}""",
    "u05_unmapped_statuses": "SELECT DISTINCT status FROM work_state WHERE status NOT IN ('telefone_validado', 'telefone_nao_validado')",
    # --- state table
    "m01_seed": f"""SELECT (SELECT max(id) FROM {CLOSED}) + 1 + c.id AS id, c.id AS cliente_id, 5 AS resposta_id,
      'pendente' AS status, 0 AS extraido, {NOW} AS data_update FROM clients c WHERE c.id NOT IN (SELECT cliente_id FROM {CLOSED})""",
    "m02_claim": f"""SELECT id, cliente_id, CASE WHEN id IN (SELECT id FROM {PENDING} ORDER BY data_update, id LIMIT 500) THEN 'processando' ELSE status END AS status,
      data_update FROM work_state""",
    "m02_claim_contracts": f"""SELECT id, CASE WHEN hit AND status IN ('pendente', 'reprocessar') THEN 'processando' ELSE status END AS status,
      CASE WHEN hit AND status IN ('pendente', 'reprocessar') THEN {NOW} ELSE data_update END AS data_update
      FROM (SELECT *, id IN (SELECT macro_id FROM {batch(2000)}) AS hit FROM contract_state)""",
    "m03_apply_results": apply_results("work_state_u"),
    "m04_apply_by_id": f"""SELECT w.id, CASE WHEN o.rut IS NULL THEN w.resposta_id ELSE o.resposta_id END AS resposta_id, coalesce(o.status, w.status) AS status,
      CASE WHEN o.rut IS NULL THEN w.data_update ELSE {NOW} END AS data_update
      FROM work_state w LEFT JOIN work_state_u u ON u.id = w.id LEFT JOIN {CLIENT_OUTCOMES} o ON o.cliente_id = u.cliente_id""",
    "m05_revert_batch": """SELECT id, CASE WHEN status = 'processando' AND id IN (SELECT id FROM work_state ORDER BY id LIMIT 500) THEN 'pendente' ELSE status END AS status FROM work_state""",
    "m05_revert_all": "SELECT id, CASE status WHEN 'processando' THEN 'pendente' ELSE status END AS status FROM work_state",
    "m06_consume": f"""SELECT id, CASE WHEN hit THEN 1 ELSE extraido END AS extraido, CASE WHEN hit THEN {NOW} ELSE data_extracao END AS data_extracao
      FROM (SELECT *, status = 'telefone_validado' AND extraido = 0 AS hit FROM work_state_u)""",
    "m07_paged_consume": f"""SELECT id, (row_number() OVER (ORDER BY id) - 1) // 500 AS pagina, 1 AS extraido, {NOW} AS data_extracao
      FROM contract_state WHERE status = 'consolidado' AND extraido = 0""",
    "m08_ledger_totals": """SELECT staging_id, count(*) AS total_rows, count(CASE WHEN validation_status IN ('new', 'valid') THEN 1 END) AS rows_success,
      count(CASE WHEN validation_status IN ('invalid', 'skipped') THEN 1 END) AS rows_failed FROM staging_rows GROUP BY 1""",
    "m08_import_ledger": f"""SELECT id, filename, status, total_rows, rows_success, rows_failed, CAST(NULL AS TIMESTAMP) AS finished_at FROM imports
      UNION ALL SELECT (SELECT max(id) + 1 FROM imports), 'nova.csv', 'completed', count(*), count(k), count(*) - count(k), {NOW}
      FROM (SELECT {rut('rut')} AS k FROM raw_clients)""",
    "m09_replace_addresses": f"""SELECT a.id, a.cliente_id, CASE WHEN d.rut IS NULL THEN a.direccion ELSE nullif(d.direccion, '') END AS direccion,
      CASE WHEN d.rut IS NULL THEN a.comuna ELSE nullif(d.comuna, '') END AS comuna,
      CASE WHEN d.rut IS NULL THEN a.region ELSE nullif(d.region, '') END AS region
      FROM addresses a JOIN clients c ON c.id = a.cliente_id
      LEFT JOIN {first(f"(SELECT * REPLACE ({rut('rut')} AS rut) FROM {CLEAN_FILE})", 'rut', 'line_no', 'rut IS NOT NULL', desc=True)} d ON d.rut = c.rut""",
    "m10_repair_unresolved": "SELECT id, CASE WHEN status = 'reprocessar' AND resposta_id IS NULL THEN 'pendente' ELSE status END AS status FROM contract_state",
    "m10_upsert_catalogue": """SELECT coalesce(r.id, c.id) AS id, coalesce(r.mensagem, c.mensagem) AS mensagem, coalesce(r.status, c.status) AS status
      FROM contract_respostas c FULL JOIN (SELECT resposta_id AS id, CAST(count(*) AS VARCHAR) AS mensagem, max(status) AS status
        FROM work_state WHERE resposta_id IS NOT NULL GROUP BY 1) r ON r.id = c.id""",
    "m11_validated_phones": not_stored(VALIDATED_PHONES, "numero", "linked_phones"),
    "m11_validated_emails": not_stored(VALIDATED_EMAILS, "endereco", "emails"),
    "m12_address_if_none": f"""SELECT c.id AS cliente_id, d.direccion, d.comuna, d.region FROM {first(CUSTOMERS, 'rut', 'line_no', 'rut IS NOT NULL')} d
      JOIN clients c ON c.rut = d.rut WHERE c.id NOT IN (SELECT cliente_id FROM addresses WHERE comuna = 'MAIPU')""",
    # --- quality
    "v01_empty_messages": f"SELECT count(*) AS n_linhas, count(CASE WHEN trim(mensagem) = '' THEN 1 END) AS n_violacoes FROM ({distribution(CONTRACT_ROLLUP, chr(34) + 'resposta_status' + chr(34) + ' <> ' + q('pendente'))})",
    "v02_unbalanced_days": f"""SELECT count(*) AS n_linhas, count(CASE WHEN ativos + inativos <> total THEN 1 END) AS n_violacoes
      FROM {summary(CONTRACT_ROLLUP, CONTRACT[0], "('excluido')")}""",
    "v03_status_coverage": "SELECT DISTINCT status FROM contract_state WHERE status NOT IN ('consolidado', 'excluido', 'reprocessar')",
    "v04_total_row": f"SELECT CAST(sum(qtd) AS BIGINT) AS soma_dias, CAST(sum(qtd) AS BIGINT) AS linha_total, TRUE AS ok FROM {DAY}",
    "v05_reconcile_rollup": " UNION ALL ".join(
        diff(n, BASE5, ROLLED5, k) for n, k in [("total", "todos"), ("status", "status"), ("mensagem", "mensagem"), ("dia", "dia")]
    ) + """ UNION ALL SELECT 'sem_resposta', count(*), count(*), count(*) - count(CASE WHEN status <> 'pendente' AND resposta_id IS NULL THEN 1 END),
      count(CASE WHEN status <> 'pendente' AND resposta_id IS NULL THEN 1 END) FROM work_state""",
    "v06_reconcile_filters": diff("dia", BASE6, ROLLED6, "dia") + " UNION ALL " + diff("empresa", BASE6, ROLLED6, "empresa"),
    "v07_staging_rows": f"""SELECT *, CASE WHEN validation_message IS NULL THEN 'valid'
        WHEN validation_message IN ('key already stored', 'key repeated in file') THEN 'skipped' ELSE 'invalid' END AS validation_status
      FROM (SELECT *, {MESSAGE} AS validation_message FROM {STAGED})""",
    "v08_duplicate_contacts": "SELECT cliente_id, numero, origem, count(*) AS n FROM phones GROUP BY ALL HAVING count(*) > 1",
    "v08_orphan_contacts": "SELECT cliente_id AS fk, count(*) AS n FROM units WHERE cliente_id NOT IN (SELECT id FROM contract_clients) GROUP BY 1",
    "v09_domain_check": f"""SELECT status AS valor, count(*) AS n, 'state' AS dominio FROM work_state WHERE status NOT IN {_state_domain} GROUP BY 1
      UNION ALL SELECT origem, count(*), 'origin' FROM phones WHERE origem NOT IN ('enriquecimento', 'validado') GROUP BY 1
      UNION ALL SELECT status, count(*), 'import' FROM imports WHERE status NOT IN ('pending', 'processing', 'completed', 'failed') GROUP BY 1
      UNION ALL SELECT validation_status, count(*), 'row' FROM staging_rows WHERE validation_status NOT IN ('new', 'valid', 'invalid', 'skipped') GROUP BY 1
      UNION ALL SELECT status, count(*), 'contract' FROM contract_state WHERE status NOT IN {_state_domain} GROUP BY 1""",
    # --- streaming: the batch answer over the same rows
    "r01_incremental_ingest": "SELECT rut, dv, telefone_validado, email_validado, sucesso, erro FROM macro_result",
    "r02_continuous_results": apply_results("work_state_u"),
    "r03_first_wins_contacts": f"SELECT cliente_id, valor AS endereco, line_no FROM {resolved(EMAIL_LINES, 'line_no')}",
    "r04_daily_rollup": "SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS qtd FROM events GROUP BY 1, 2",
    "r05_key_state": f"SELECT o.*, n.tentativas FROM {outcomes()} o JOIN (SELECT rut, count(*) AS tentativas FROM macro_result GROUP BY 1) n ON n.rut = o.rut",
    "r05_key_transitions": f"""WITH l AS (SELECT {trim('rut')} AS rut, line_no, {code()} AS c FROM macro_result WHERE {trim('rut')} <> ''),
      taken AS (SELECT l.*, row_number() OVER (PARTITION BY rut ORDER BY line_no) AS k FROM l
        WHERE line_no <= coalesce((SELECT min(f.line_no) FROM l f WHERE f.rut = l.rut AND f.c IN {FINAL}), line_no))
      SELECT rut, 2 * k - 1 AS n, line_no, 'pendente' AS de, 'processando' AS para, CAST(NULL AS INTEGER) AS resposta_id FROM taken
      UNION ALL SELECT rut, 2 * k, line_no, 'processando', {status('c')}, c FROM taken""",
    # --- function and API surface
    "x01_sql_functions": f"SELECT line_no, {rut('rut')} AS rut, {region('region')} AS region, limpa AS comuna FROM {with_commune()}",
    "x01_sql_interpret": f"""SELECT line_no, resposta_id, {status('resposta_id')} AS status, numero FROM (
      SELECT line_no, {code()} AS resposta_id, {phone('telefone_validado')} AS numero FROM macro_result)""",
    "x02_claimable": f"SELECT id, cliente_id, rut FROM {PENDING} ORDER BY data_update, id LIMIT 2000",
    "x02_refresh": f"SELECT *, {NOW} AS atualizado_em FROM {STATUS}",
    "x03_view_pending": f"SELECT status, count(*) AS n, max(id) AS max_id FROM {PENDING} GROUP BY 1",
    "x03_view_finished": """SELECT w.status, count(*) AS n, count(p.id) AS telefones, count(e.id) AS emails
      FROM work_state w JOIN clients c ON c.id = w.cliente_id LEFT JOIN linked_phones p ON p.id = w.telefone_id LEFT JOIN emails e ON e.id = w.email_id
      WHERE w.status IN ('telefone_validado', 'telefone_nao_validado') GROUP BY 1""",
    "x03_view_client_contacts": """SELECT tipo, origem, count(*) AS n, count(DISTINCT cliente_id) AS clientes FROM (
        SELECT 'endereco' AS tipo, NULL AS origem, cliente_id FROM addresses
        UNION ALL SELECT 'telefone', origem, cliente_id FROM linked_phones
        UNION ALL SELECT 'email', origem, cliente_id FROM emails
        UNION ALL SELECT NULL, NULL, id FROM clients WHERE id NOT IN (SELECT cliente_id FROM addresses UNION SELECT cliente_id FROM linked_phones UNION SELECT cliente_id FROM emails)) x
      WHERE cliente_id IN (SELECT id FROM clients) GROUP BY 1, 2""",
    "x04_dashboard_nothing_selected": "SELECT '' AS mensagem, CAST(0 AS BIGINT) AS quantidade WHERE false",
    "x04_dashboard_summary": both(summary(f"(SELECT * FROM {DAY} WHERE strftime(dia, '%Y-%m') IN ('1997-05', '1998-10'))", *CONTACT)),
    "x04_dashboard_distribution": distribution(
        f"(SELECT * FROM {CONTRACT_ROLLUP} WHERE fornecedor = 'fornecedor1' AND empresa = 'AMERICA')", "resposta_status <> 'pendente'"
    ),
    "x04_dashboard_files": f"""SELECT arquivo_origem, CAST(sum(qtd) AS BIGINT) AS quantidade FROM {CONTRACT_ROLLUP} WHERE fornecedor = 'fornecedor2'
      GROUP BY 1""",
}


# Date columns go out as ISO text, as in the registered queries.
DATES = {
    "s09_insert_ignore_clients": "data_nascimento",
    "s11_update_join": "data_nascimento",
    "s12_full_refresh": "dia",
    "s13_rollup_reader": "data_carga",
    "p04_parse_date": "data_nascimento",
    "f03_day_selection": "dia",
    "f03_month_without_days": "dia",
    "f04_dimension_filters": "dia",
    "j05_client_contacts": "data_nascimento",
    "a01_day_status_message": "dia",
    "a03_import_statistics": "data_carga",
    "w04_first_row_per_key": "data_nascimento",
    "t05_day_options": "dia",
    "t06_sorted_rollup": "dia",
    "r04_daily_rollup": "dia",
}


# The same tables, reached through change logs and buckets.
SAME = {
    "m02_claim_log": "m02_claim",
    "m03_apply_results_log": "m03_apply_results",
    "m05_revert_batch_log": "m05_revert_batch",
    "m06_consume_log": "m06_consume",
    "m09_update_buckets": "m09_replace_addresses",
    "s11_update_buckets": "s11_update_join",
    "f03_stored_days": "f03_day_selection",
    "x01_sql_interpret_body": "p15_interpret_body",
    "x03_rows_pending": "w01_latest_pending",
    "x03_rows_finished": "j04_finished_contacts_created",
    "x04_dashboard_file_statistics": "a19_file_statistics",
}
ORACLES |= {new: ORACLES[old] for new, old in SAME.items()}
ORACLES["x03_rows_client_contacts"] = ORACLES["j05_client_contacts"].replace("FROM phones", "FROM linked_phones")
DATES["x03_rows_client_contacts"] = "data_nascimento"
DATES |= {new: DATES[old] for new, old in SAME.items() if old in DATES}


def _final(name: str) -> str:
    sql, day = ORACLES[name], DATES.get(name)
    return f"SELECT * REPLACE (CAST({day} AS VARCHAR) AS {day}) FROM ({sql})" if day else sql


def oracle_sql() -> dict[str, str]:
    return {name: with_inputs(_final(name)) for name in ORACLES}
