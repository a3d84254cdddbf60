"""Lookup tables whose content must equal the published rules.

Data only. Spellings, truncations and odd keys are part of the values.
"""

from __future__ import annotations

# --- Regions -----------------------------------------------------------------
# Accepted region spellings, plain and accented.
VALID_REGIONS = [
    "METROPOLITANA DE SANTIAGO",
    "DE VALPARAISO",
    "DEL BIOBIO",
    "DE LA ARAUCANIA",
    "DEL LIBERTADOR GRAL. BERNARDO O'HIGGINS",
    "DE LOS LAGOS",
    "DE COQUIMBO",
    "DE ANTOFAGASTA",
    "DE LOS RIOS",
    "DE TARAPACA",
    "DE ARICA Y PARINACOTA",
    "DE MAGALLANES Y LA ANTARTICA CHILENA",
    "DE AYSEN DEL GRAL. CARLOS IBANEZ DEL CAMPO",
    "DEL MAULE",
    "DE NUBLE",
    "DE ATACAMA",
    "DE VALPARAÍSO",
    "DEL BIOBÍO",
    "DE LA ARAUCANÍA",
    "DE LOS RÍOS",
    "DE TARAPACÁ",
    "DE MAGALLANES Y LA ANTÁRTICA CHILENA",
    "DE AYSÉN DEL GRAL. CARLOS IBÁÑEZ DEL CAMPO",
    "DE ÑUBLE",
]

# Region names cut to ten characters in the source files.
TRUNCATED_REGIONS = {
    "METROPOLIT": "METROPOLITANA DE SANTIAGO",
    "DE VALPARA": "DE VALPARAÍSO",
    "DEL BIOBIO": "DEL BIOBÍO",
    "DE LA ARAU": "DE LA ARAUCANÍA",
    "DEL LIBERT": "DEL LIBERTADOR GRAL. BERNARDO O'HIGGINS",
    "DE LOS LAG": "DE LOS LAGOS",
    "DE COQUIMB": "DE COQUIMBO",
    "DE ANTOFAG": "DE ANTOFAGASTA",
    "DE LOS RIO": "DE LOS RÍOS",
    "DE TARAPAC": "DE TARAPACÁ",
    "DE ARICA Y": "DE ARICA Y PARINACOTA",
    "DE MAGALLA": "DE MAGALLANES Y LA ANTÁRTICA CHILENA",
    "DE AYSEN D": "DE AYSÉN DEL GRAL. CARLOS IBÁÑEZ DEL CAMPO",
}

INVALID_REGIONS = ["CHILE", "VIÑA DEL MAR", "PUENTE ALTO"]

# Region names of the customer report: accented spellings only.
REPORT_REGIONS = [
    "METROPOLITANA DE SANTIAGO",
    "DE VALPARAÍSO",
    "DEL BIOBÍO",
    "DE LA ARAUCANÍA",
    "DEL LIBERTADOR GRAL. BERNARDO O'HIGGINS",
    "DE LOS LAGOS",
    "DE COQUIMBO",
    "DE ANTOFAGASTA",
    "DE LOS RÍOS",
    "DE TARAPACÁ",
    "DE ARICA Y PARINACOTA",
    "DE MAGALLANES Y LA ANTÁRTICA CHILENA",
    "DE AYSÉN DEL GRAL. CARLOS IBÁÑEZ DEL CAMPO",
    "DEL MAULE",
    "DE ÑUBLE",
    "DE ATACAMA",
]

# --- Communes ----------------------------------------------------------------
# A commune starting with one of these is rejected.
BAD_FIRST_CHARS = ".#-(/,"

# Region names that turn up in the commune column, cut at any length.
REGION_PREFIXES = [
    "REGION METROPOLITANA",
    "REGION METROPOLITAN",
    "REGION METROPOLITA",
    "REGION METROPOLI",
    "REGION METROPOL",
    "REGION METROPO",
    "REGION METRO",
    "REGION METROP",
    "REGION METR",
    "REGION MET",
    "REGION ME",
    "METROPOLITANA DE SANTIAGO",
    "METROPOLITANA DE SANTIAG",
    "MAGALLANES Y LA ANTARTICA CHILENA",
    "MAGALLANES Y LA ANTARTICA CHILEN",
    "MAGALLANES Y LA ANTARTICA CHILE",
    "MAGALLANES Y LA ANTARTICA CHIL",
    "MAGALLANES Y LA ANTARTICA CHI",
    "MAGALLANES Y LA ANTARTICA CH",
    "MAGALLANES Y LA ANTARTICA C",
    "MAGALLANES Y LA ANTARTICA",
    "MAGALLANES Y LA ANTARTIC",
    "MAGALLANES Y LA ANTARTI",
    "MAGALLANES Y LA ANTART",
    "MAGALLANES Y LA ANTAR",
    "MAGALLANES Y LA ANTA",
    "MAGALLANES Y LA ANT",
    "MAGALLANES Y LA AN",
    "MAGALLANES Y LA A",
    "MAGALLANES Y LA",
    "MAGALLANES Y L",
    "ARICA Y PARINACOTA",
    "ARICA Y PARINACOT",
    "ARICA Y PARINACO",
    "ARICA Y PARINAC",
    "ARICA Y PARINA",
    "ARICA Y PARIN",
    "ARICA Y PARI",
]

# Commune corrections; None means "not a commune". The lookup key has its
# accents folded, so keys holding an Ñ never match: kept, as in the rules.
COMMUNE_CORRECTIONS = {
    "REGION METROPOLITANA": None,
    "ARICA Y PARINACOTA": None,
    "ESTACION CENTRA": "ESTACION CENTRAL",
    "ESTACION CENTR": "ESTACION CENTRAL",
    "ESTACION CENT": "ESTACION CENTRAL",
    "ESTACION CEN": "ESTACION CENTRAL",
    "ESTACION CE": "ESTACION CENTRAL",
    "ESTACION C": "ESTACION CENTRAL",
    "DIEGO DE ALMAGR": "DIEGO DE ALMAGRO",
    "DIEGO DE ALMA": "DIEGO DE ALMAGRO",
    "DIEGO DE AL": "DIEGO DE ALMAGRO",
    "TORRES DEL PAIN": "TORRES DEL PAINE",
    "TORRES DEL PAI": "TORRES DEL PAINE",
    "TORRES D": "TORRES DEL PAINE",
    "POZO ALMONT": "POZO ALMONTE",
    "POZO ALM": "POZO ALMONTE",
    "PANGUIPULL": "PANGUIPULLI",
    "LOS MUERMO": "LOS MUERMOS",
    "PICHIDANGU": "PICHIDANGUI",
    "PICHIDEGU": "PICHIDEGUA",
    "SANTO DOMING": "SANTO DOMINGO",
    "ANTOFAGAST": "ANTOFAGASTA",
    "ANTOFAG": "ANTOFAGASTA",
    "ANTOF": "ANTOFAGASTA",
    "MIRAFLORES ALT": "MIRAFLORES ALTO",
    "MIRAFLORES AL": "MIRAFLORES ALTO",
    "MIRAFORES": "MIRAFLORES",
    "MIRAFLORE": "MIRAFLORES",
    "REÑACAALTO": "REÑACA ALTO",
    "SANTAJULIA": "SANTA JULIA",
    "NUEVAGRANADILLA": "NUEVA GRANADILLA",
    "NUÑOA": "ÑUÑOA",
    "PLATYA ANCHA": "PLAYA ANCHA",
    "MELIPILÑLA": "MELIPILLA",
    "CHORRILOS": "CHORRILLOS",
    "DEPARTAMETO": "DEPARTAMENTO",
    "FORESTAL FOIRESTAL ALTO": "FORESTAL ALTO",
    "FOREST AL BAJO": "FORESTAL BAJO",
    "LOS LAGO": "LOS LAGOS",
    "LOS LAG": "LOS LAGOS",
    "HIJUEL": "HIJUELAS",
    "HIJUELA": "HIJUELAS",
    "SAN FERNAND": "SAN FERNANDO",
    "PLACILLA DE PENUE": "PLACILLA DE PENUELAS",
    "PLACILLA DE PENU": "PLACILLA DE PENUELAS",
    "LINARE": "LINARES",
    "PAILL": "PAILLACO",
    "OSORN": "OSORNO",
    "LA SE": "LA SERENA",
    "LA SER": "LA SERENA",
    "LA SERE": "LA SERENA",
    "LA SEREN": "LA SERENA",
    "O'HIGG": "O'HIGGINS",
    "O'HIGGI": "O'HIGGINS",
    "O'HIGGIN": "O'HIGGINS",
    "CONCEP": "CONCEPCION",
    "RIO BUEN": "RIO BUENO",
    "LAGO R": "LAGO RANCO",
    "LAGO RAN": "LAGO RANCO",
    "CHILLAN VIE": "CHILLAN VIEJO",
    "CHILLAN V": "CHILLAN VIEJO",
    "CASAB": "CASABLANCA",
    "SAGRADA F": "SAGRADA FAMILIA",
    "COQUIMB": "COQUIMBO",
    "VALLE": "VALLENAR",
    "VALPAR": "VALPARAISO",
    "VALPA": "VALPARAISO",
    "VALPARA": "VALPARAISO",
    "VALPARAI": "VALPARAISO",
    "LA LI": "LA LIGUA",
    "LA LIGU": "LA LIGUA",
    "POBL. P. HURTA": "POBL. P. HURTADO",
    "POBL. P. HURTAD": "POBL. P. HURTADO",
    "VILLA AL": "VILLA ALEMANA",
    "SANTA CLA": "SANTA CLARA",
    "LOS ANGELE": "LOS ANGELES",
    "LOS ANG": "LOS ANGELES",
    "VINA DEL M": "VINA DEL MAR",
    "VINA DEL MA": "VINA DEL MAR",
    "VINA D": "VINA DEL MAR",
    "VINA": "VINA DEL MAR",
    "PEDRO AGUI": "PEDRO AGUIRRE CERDA",
    "PADRE LAS CAS": "PADRE LAS CASAS",
    "VICTORI": "VICTORIA",
    "LONCOCH": "LONCOCHE",
    "ACHUPALLA": "ACHUPALLAS",
    "LAUTA": "LAUTARO",
    "PITRUFQ": "PITRUFQUEN",
    "ALTO HOS": "ALTO HOSPICIO",
    "ALTO HOSP": "ALTO HOSPICIO",
    "SAN E": "SAN ESTEBAN",
    "CALAM": "CALAMA",
    "RECRE": "RECREO",
    "MIRADOR DE RENA": "MIRADOR DE RENACA",
    "GLORIASNAVALES": "GLORIAS NAVALES",
    "BIOBIO": "BIO BIO",
    "CHORRILLOS": "CHORRILLOS",
    "REÑACA ALTO C": "REÑACA ALTO",
    "REÑACA ALTO B": "REÑACA ALTO",
    "REÑACA ALTO O": "REÑACA ALTO",
    "REÑACA ALTO E": "REÑACA ALTO",
    "REÑACA ALTO K": "REÑACA ALTO",
    "ACHUPALLAS A": "ACHUPALLAS",
    "ACHUPALLAS B": "ACHUPALLAS",
    "MIRAFLORES ALTO B": "MIRAFLORES ALTO",
    "PLAYA ANCHA D": "PLAYA ANCHA",
    "PLAYA ANCHA B": "PLAYA ANCHA",
    "SAN VICENTE T": "SAN VICENTE",
    "TEMUCO P": "TEMUCO",
    "CHANARAL A": "CHANARAL",
    "CONDOMINIO": None,
    "CONDOMINI": None,
    "CONDOMINIU": None,
    "CONDOMIN": None,
    "DEPARTAMENTO": None,
    "DEPARTAMEN": None,
    "DEPARTAMENT": None,
    "DEPARTAME": None,
    "DEPARTAM": None,
    "DEPTO": None,
}

# --- States and origins ------------------------------------------------------
PENDING = "pendente"
CLAIMED = "processando"
PHONE_OK = "telefone_validado"
PHONE_NOT_OK = "telefone_nao_validado"
STATES = [PENDING, CLAIMED, PHONE_OK, PHONE_NOT_OK]
OPEN_STATES = [PENDING, CLAIMED]

ENRICHED = "enriquecimento"
VALIDATED = "validado"
ORIGINS = [ENRICHED, VALIDATED]

IMPORT_STATES = ["pending", "processing", "completed", "failed"]
ROW_STATES = ["new", "valid", "invalid", "skipped"]

STATUS_LABELS = {
    "pendente": "Pendente",
    "processando": "Processando",
    "telefone_validado": "Telefone validado",
    "telefone_nao_validado": "Telefone não validado",
}

# --- Outcome catalogue -------------------------------------------------------
# (id, message, status)
OUTCOMES = [
    (1, "Sucesso com telefone e e-mail", "telefone_validado"),
    (2, "Sucesso sem dados", "telefone_nao_validado"),
    (3, "Usuário já registrado", "telefone_nao_validado"),
    (4, "Falha de conexão / API", "telefone_nao_validado"),
    (5, "Aguardando processamento", "telefone_nao_validado"),
    (6, "Sucesso apenas com telefone", "telefone_validado"),
    (7, "Sucesso apenas com e-mail", "telefone_nao_validado"),
    (8, "Telefone invalido", "telefone_nao_validado"),
]

# Substrings of the lower-cased error text.
REGISTERED_USER_ERRORS = [
    "usuarioregistrado",
    "usuario registrado",
    "ya registrado",
    "já registrado",
]
CONNECTION_ERRORS = [
    "falha de conexao",
    "falha de conexão",
    "timeout",
    "connection",
    "connectionerror",
    "httperror",
    "requestexception",
]
UNKNOWN_ERROR = "Erro ou retorno desconhecido"

# --- Older contract model ----------------------------------------------------
# Return codes: (id, message, catalogue status)
CONTRACT_OUTCOMES = [
    (0, "Conta Contrato nao existe", "excluir"),
    (1, "Doc. fiscal não existe", "excluir"),
    (2, "Titularidade não confirmada", "excluir"),
    (3, "Titularidade confirmada com contrato ativo", "consolidado"),
    (4, "Titularidade confirmada com contrato inativo", "reprocessar"),
    (5, "Titularidade confirmada com inst. suspensa", "reprocessar"),
    (6, "Aguardando processamento", "pendente"),
    (7, "Doc. Fiscal nao cadastrado no SAP", "excluir"),
    (8, "Parceiro informado nao possui conta contrato", "excluir"),
    (9, "Status instalacao: desligado", "reprocessar"),
    (10, "Status instalacao: ligado", "consolidado"),
    (11, "ERRO", "reprocessar"),
]

# Catalogue status to state; anything else is "reprocessar".
CATALOGUE_STATUS = {
    "excluir": "excluido",
    "excluido": "excluido",
    "consolidado": "consolidado",
    "reprocessar": "reprocessar",
    "pendente": "pendente",
}

EMPTY_BODY_OUTCOME = (6, "pendente")
UNKNOWN_BODY_OUTCOME = (11, "reprocessar")

# Ordered text rules for bodies without a usable code: (fragment, id, status)
BODY_TEXT_RULES = [
    ("peak connections limit", 11, "reprocessar"),
    ("limit_exceeded", 11, "reprocessar"),
    ("erro_retry", 11, "reprocessar"),
    ("timeout", 11, "reprocessar"),
    ("erro:", 11, "reprocessar"),
]

CONTRACT_ACTIVE = ["consolidado"]
CONTRACT_INACTIVE = ["excluido", "reprocessar"]
CONTRACT_OPEN = ["pendente", "reprocessar"]
DEFAULT_SUPPLIER = "fornecedor2"
ACTIVE_CONTRACT_MESSAGE = "Titularidade confirmada com contrato ativo"

# --- Message reports ---------------------------------------------------------
REQUEST_ERROR_KEYWORDS = [
    "TIMEOUT",
    "LIMIT_EXCEEDED",
    "ERRO",
    "ERROR",
    "CONNECTION",
    "CONNREFUSED",
    "REFUSED",
    "RESET",
    "SOCKET",
    "PEAK CONNECTIONS LIMIT",
    "EXCEEDED",
    "UNAVAILABLE",
    "UNREACHABLE",
    "NAME OR SERVICE NOT KNOWN",
    "EOF",
    "502",
    "503",
    "504",
    "500",
]
NO_ERROR_VALUES = ["FALSO", "FALSE", "0", ""]
ERROR_TEXT_COLUMNS = ["Msg", "mensagem", "resposta", "resposta_lista", "Status"]
MESSAGE_COLUMNS = ["Msg", "Status", "Error", "erro", "mensagem", "resposta", "resposta_lista"]
EXCLUDED_MESSAGES = ["", "N/A", "ERRO: DESTINATION NAME IS NULL"]

NO_REGION = "(sem região)"
NO_COMMUNE = "(sem cidade)"
HISTORIC_FILE = "Dados históricos"
UNTRACKED_FILE = "operacional"

# --- File layouts ------------------------------------------------------------
CUSTOMER_FILE = ["rut", "dv", "nombre", "sexo", "direccion", "comuna", "region", "FECHA NAC"]
RESULT_FILE = ["RUT", "DV", "TELEFONE_VALIDADO", "EMAIL_VALIDADO", "SUCESSO", "ERRO"]
EXPORT_FILE = [
    "RUT", "DV", "NOME", "SEXO", "DATA_NASCIMENTO", "IDADE",
    "DIRECCION", "COMUNA", "REGION",
    "telefone_1", "telefone_2", "telefone_3", "telefone_4", "telefone_5",
    "email_1", "email_2",
]
CONTRACT_REPORT_FILE = [
    "UC Ativa", "CPF", "Nome", "Telefones", "Endereco Completo", "Distribuidora", "Retorno",
]
PROVENANCE_FILE = [
    "cpf", "nome", "uc", "distribuidora", "endereco", "numero", "bairro",
    "cidade", "uf", "cep", "telefones", "origem_uc",
]
EXPORT_PHONES = 5
EXPORT_EMAILS = 2
DEFAULT_BATCH = 2000
RUNNER_BATCH = 500
