"""Common table expressions of the SQL equivalents: the roles of ``roles.py`` spelt in SQL."""

from __future__ import annotations

from rollbook.functions.text import NULL_SENTINELS
from rollbook.plans.serving import SERVING_COLUMNS
from rollbook.sources.registry import EMPRESAS, ESTABELECIMENTOS
from workload.roles import NEW_KEY, NEW_STAMP, OLD_KEY, OLD_STAMP


def zpad(expr: str, width: int) -> str:
    text = f"CAST({expr} AS VARCHAR)"
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END"


def layout_select(layout, fields: dict[str, str]) -> str:
    return ", ".join(f"{fields.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in layout.columns)


MONEY = "replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"
_EMPRESAS = layout_select(
    EMPRESAS,
    {
        "cnpj_basico": zpad("c_custkey", 8),
        "razao_social": "c_name",
        "natureza_juridica": zpad("c_nationkey", 4),
        "qualificacao_responsavel": zpad("c_nationkey", 2),
        "capital_social": MONEY,
        "porte": "substr(c_mktsegment, 1, 2)",
        "ente_federativo_responsavel": "CASE WHEN c_acctbal < 0 THEN c_mktsegment END",
    },
)
_BRANCH_FIELDS = {
    "cnpj_basico": zpad("o_custkey", 8),
    "cnpj_ordem": zpad("(o_orderkey // 100)", 4),
    "cnpj_dv": zpad("(o_orderkey % 100)", 2),
    "identificador_matriz_filial": "CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '2' END",
    "nome_fantasia": "o_orderpriority || ' ' || o_orderstatus",
    "situacao_cadastral": "o_orderstatus",
    "data_situacao_cadastral": "strftime(o_orderdate, '%Y%m%d')",
    "motivo_situacao_cadastral": "substr(o_orderpriority, 1, 1)",
    "data_inicio_atividade": "strftime(o_orderdate, '%Y%m%d')",
    "cnae_fiscal": zpad("CAST(floor(o_totalprice / 20000) AS BIGINT)", 7),
    "tipo_logradouro": "'RUA'",
    "numero": "CAST(o_custkey AS VARCHAR)",
    "uf": "upper(substr(o_orderpriority, 3, 2))",
    "municipio": zpad("day(o_orderdate)", 4),
    "correio_eletronico": "'c' || CAST(o_custkey AS VARCHAR) || '@example.com'",
}
_BRANCHES = layout_select(ESTABELECIMENTOS, _BRANCH_FIELDS)
_STAGED = layout_select(
    ESTABELECIMENTOS,
    {
        **_BRANCH_FIELDS,
        "situacao_cadastral": "CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END",
        "motivo_situacao_cadastral": (
            "CASE WHEN substr(o_orderpriority, 1, 1) <> '3' THEN substr(o_orderpriority, 1, 1) END"
        ),
    },
)
_BLANK = layout_select(
    ESTABELECIMENTOS,
    {
        "cnpj_basico": zpad("p_partkey", 8),
        "cnpj_ordem": "CASE WHEN p_size > 25 THEN '   ' END",
        "cnpj_dv": "'00'",
        "nome_fantasia": "p_name",
    },
)
_SPECIAL = {
    "cnpj_completo": "e.cnpj_basico || b.cnpj_ordem || b.cnpj_dv",
    "cnpj_basico": "e.cnpj_basico",
    "natureza_juridica_descricao": "nat.descricao",
    "porte_descricao": "prt.descricao",
    "motivo_situacao_descricao": "mot.descricao",
    "cnae_fiscal_descricao": "cn.descricao",
    "municipio_descricao": "mun.descricao",
    "run_key": f"'{OLD_KEY}'",
    "updated_at": f"'{OLD_STAMP}'",
}


def _star_column(c: str) -> str:
    if c in _SPECIAL:
        return f"{_SPECIAL[c]} AS {c}"
    if c in EMPRESAS.columns:
        return f"e.{c}"
    return f"b.{c}" if c in ESTABELECIMENTOS.columns else f"s.{c}"


STAR_COLUMNS = ", ".join(_star_column(c) for c in SERVING_COLUMNS)
WHITE = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"


def cleaned(expr: str) -> str:
    markers = ", ".join(f"'{v}'" for v in ("", *NULL_SENTINELS))
    return f"CASE WHEN trim({expr}, {WHITE}) NOT IN ({markers}) THEN trim({expr}, {WHITE}) END"


_WIPED = "(c_acctbal < 0 AND c_mktsegment = 'FURNITURE')"
_RAW = {
    "cnpj_basico": (
        "CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN '' "
        "WHEN c_acctbal < 0 AND c_mktsegment = 'MACHINERY' THEN '00000000' "
        f"ELSE chr(160) || {zpad('c_custkey', 8)} || chr(9) || ' ' END"
    ),
    "razao_social": "'  ' || c_name || chr(160)",
    "natureza_juridica": f"CASE WHEN c_nationkey = 7 THEN '000' ELSE {zpad('c_nationkey', 4)} END",
    "qualificacao_responsavel": f"CASE WHEN c_nationkey = 8 THEN 'na' ELSE {zpad('c_nationkey', 2)} END",
    "capital_social": MONEY,
    "porte": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' NA ' ELSE substr(c_mktsegment, 1, 2) END",
    "ente_federativo_responsavel": (
        "CASE WHEN c_acctbal > 9000 THEN 'N/A' WHEN c_acctbal > 8000 THEN '0001-01-01' ELSE '' END"
    ),
}
_STEM = (
    "CASE lang WHEN 'en' THEN 'Empresas' WHEN 'fr' THEN 'Socios' WHEN 'de' THEN 'old_CNAES' ELSE 'Notes' END "
    "|| CAST(doc_id AS VARCHAR) || CASE WHEN source LIKE '%3' THEN '.txt' WHEN source LIKE '%5' THEN '.ZIP' "
    "ELSE '.zip' END"
)

# Each fragment may use the ones before it.
FRAGMENTS: dict[str, str] = {
    "empresas": f"SELECT {_EMPRESAS} FROM customer",
    "simples": (
        f"SELECT {zpad('c_custkey', 8)} AS cnpj_basico, CASE WHEN c_acctbal >= 5000 THEN 'S' ELSE 'N' END AS "
        "opcao_pelo_simples, CASE WHEN c_acctbal >= 5000 THEN '20150101' END AS data_opcao_simples, "
        "CAST(NULL AS VARCHAR) AS data_exclusao_simples, CASE WHEN c_nationkey < 5 THEN 'S' ELSE 'N' END AS "
        "opcao_pelo_mei, CAST(NULL AS VARCHAR) AS data_opcao_mei, CAST(NULL AS VARCHAR) AS data_exclusao_mei "
        "FROM customer WHERE c_mktsegment <> 'MACHINERY'"
    ),
    "estabelecimentos": f"SELECT {_BRANCHES} FROM orders",
    "known_nations": "SELECT * FROM nation",
    "cnaes": f"SELECT {zpad('n_nationkey', 7)} AS codigo, n_name AS descricao FROM known_nations",
    "municipios": f"SELECT {zpad('n_nationkey', 4)} AS codigo, n_name AS descricao FROM known_nations",
    "motivos": (
        "SELECT substr(o_orderpriority, 1, 1) AS codigo, min(substr(o_orderpriority, 3)) AS descricao "
        "FROM orders GROUP BY 1"
    ),
    "portes": "SELECT substr(c_mktsegment, 1, 2) AS codigo, min(c_mktsegment) AS descricao FROM customer GROUP BY 1",
    "star": (
        f"SELECT {STAR_COLUMNS} FROM estabelecimentos b JOIN empresas e ON e.cnpj_basico = b.cnpj_basico "
        "LEFT JOIN cnaes cn ON cn.codigo = b.cnae_fiscal LEFT JOIN municipios mun ON mun.codigo = b.municipio "
        "LEFT JOIN municipios nat ON nat.codigo = e.natureza_juridica "
        "LEFT JOIN motivos mot ON mot.codigo = b.motivo_situacao_cadastral "
        "LEFT JOIN portes prt ON prt.codigo = e.porte LEFT JOIN simples s ON s.cnpj_basico = e.cnpj_basico"
    ),
    "main_rows": f"SELECT {_BRANCHES} FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'",
    "staging_rows": (
        f"SELECT {_STAGED} FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1997-01-01') "
        f"UNION ALL SELECT {_BLANK} FROM part"
    ),
    "raw_companies": "SELECT "
    + ", ".join(f"CASE WHEN {_WIPED} THEN ' ' || chr(9) ELSE {expr} END AS {c}" for c, expr in _RAW.items())
    + " FROM customer",
    "clean_companies": "SELECT " + ", ".join(f"{cleaned(c)} AS {c}" for c in EMPRESAS.columns) + " FROM raw_companies",
    "files": (
        f"SELECT {_STEM} AS name, source || '/' || {_STEM} AS path, source = 'src7' AS is_dir, n_chars AS size, "
        "'' AS modified, md5(text) AS etag, source, lang FROM documents"
    ),
    "run_events": (
        "SELECT CAST(user_id AS VARCHAR) AS job_id, strftime(ts, '%Y-%m-%d') AS run_key, "
        "'step_' || json_extract_string(props, '$.k') AS step_name, CASE event_type WHEN 'click' THEN 'RUNNING' "
        "WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'SKIPPED' ELSE 'PENDING' END "
        "AS status, ts, CASE WHEN event_type = 'error' THEN 'event ' || CAST(event_id AS VARCHAR) END AS error, "
        "CASE WHEN event_type = 'purchase' THEN 'out/' || CAST(event_id AS VARCHAR) END AS artifact_path, "
        "event_id AS seq FROM events"
    ),
    "runs": (
        "SELECT job_id, run_key, CASE WHEN last = 'FAILED' AND attempts >= 3 THEN 'DEAD' ELSE last END AS status, attempts, "
        "3 AS max_attempts, started_at + INTERVAL 1 HOUR AS lease_until, created_at, started_at, finished_at, last_error "
        "FROM (SELECT job_id, arg_min(run_key, seq) AS run_key, arg_max(status, seq) AS last, "
        "CAST(count(*) FILTER (live AND status = 'RUNNING') AS INTEGER) AS attempts, min(ts) AS created_at, "
        "max(ts) FILTER (live AND status = 'RUNNING') AS started_at, max(ts) FILTER (live AND ended) AS finished_at, "
        "(array_agg(error ORDER BY seq DESC) FILTER (live AND ended))[1] AS last_error FROM (SELECT e.*, "
        "status IN ('SUCCESS', 'FAILED', 'SKIPPED', 'DEAD') AS ended, NOT EXISTS (SELECT 1 FROM run_events p WHERE "
        "p.job_id = e.job_id AND p.status = 'PENDING' AND p.seq >= e.seq) AS live FROM run_events e) GROUP BY job_id)"
    ),
}
STAR = ("empresas", "simples", "estabelecimentos", "known_nations", "cnaes", "municipios", "motivos", "portes", "star")
MERGE = ("main_rows", "staging_rows")
PRESENT = " AND ".join(f"NULLIF(trim(s.{c}), '') IS NOT NULL" for c in ESTABELECIMENTOS.key)
SAME_KEY = " AND ".join(f"s.{c} = t.{c}" for c in ESTABELECIMENTOS.key)
CHANGED = "(" + " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in ESTABELECIMENTOS.data_columns) + ")"
_S = ", ".join(f"s.{c}" for c in ESTABELECIMENTOS.columns)
_T = ", ".join(f"t.{c}" for c in ESTABELECIMENTOS.columns)
FRAGMENTS["merged"] = (
    f"SELECT {_S}, '{NEW_KEY}' AS run_key, '{NEW_STAMP}' AS created_at, '{NEW_STAMP}' AS updated_at, "
    f"'insert' AS op FROM staging_rows s WHERE {PRESENT} AND NOT EXISTS (SELECT 1 FROM main_rows t WHERE {SAME_KEY}) "
    f"UNION ALL SELECT {_S}, '{NEW_KEY}', '{OLD_STAMP}', '{NEW_STAMP}', 'update' FROM staging_rows s JOIN main_rows t "
    f"ON {SAME_KEY} WHERE {PRESENT} AND {CHANGED} "
    f"UNION ALL SELECT {_S}, '{OLD_KEY}', '{OLD_STAMP}', '{OLD_STAMP}', 'keep' FROM staging_rows s JOIN main_rows t "
    f"ON {SAME_KEY} WHERE {PRESENT} AND NOT {CHANGED} "
    f"UNION ALL SELECT {_T}, '{OLD_KEY}', '{OLD_STAMP}', '{OLD_STAMP}', 'delete' FROM main_rows t "
    f"WHERE NOT EXISTS (SELECT 1 FROM staging_rows s WHERE {SAME_KEY})"
)
MERGED = (*MERGE, "merged")
CLEAN = ("raw_companies", "clean_companies")
#: Branches of which a third belong to one company.
SKEWED_BRANCHES = (
    f"SELECT {_BRANCHES} FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM orders)"
)
RUNS = ("run_events", "runs")


def sql(names: tuple[str, ...] | str, body: str, **replaced: str) -> str:
    """``WITH`` the named fragments; ``replaced`` puts another text in place of one."""
    names = (names,) if isinstance(names, str) else names
    parts = [f"{n} AS ({replaced.get(n, FRAGMENTS[n])})" for n in names]
    return f"WITH {', '.join(parts)} {body}"
