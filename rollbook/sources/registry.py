"""The eleven source tables: columns in file order, file-name aliases, keys, lengths, load policy."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MERGE, REPLACE, REPLACE_KEYED, LOOKUP = "merge", "replace", "replace_keyed", "lookup"


@dataclass(frozen=True)
class Layout:
    name: str
    columns: tuple[str, ...]
    aliases: tuple[str, ...]
    policy: str
    key: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict, hash=False)

    @property
    def required(self) -> tuple[str, ...]:
        return self.key

    @property
    def data_columns(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c not in self.key)

    @property
    def schema(self) -> T.StructType:
        return text_schema(self.columns)


def text_schema(columns: tuple[str, ...] | list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# The published file layout. Column order is the order of fields in the headerless files.
_COMPANY = (
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte",
    "ente_federativo_responsavel",
)
_BRANCH = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral", "nm_cidade_exterior", "pais",
    "data_inicio_atividade", "cnae_fiscal", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro",
    "numero", "complemento", "bairro", "cep", "uf", "municipio", "ddd1", "telefone1", "ddd2", "telefone2",
    "ddd_fax", "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
)
_PARTNER = (
    "cnpj_basico", "identificador_socio", "nome_socio", "cnpj_cpf_socio", "qualificacao_socio",
    "data_entrada_sociedade", "pais", "representante_legal", "nome_representante",
    "qualificacao_representante", "faixa_etaria",
)
_TAX_REGIME = (
    "cnpj_basico", "opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_pelo_mei",
    "data_opcao_mei", "data_exclusao_mei",
)

# Declared maximum lengths of the coded fields.
_COMPANY_LENGTHS = {"cnpj_basico": 8, "natureza_juridica": 4, "qualificacao_responsavel": 2, "porte": 2}
_BRANCH_LENGTHS = {
    "cnpj_basico": 8, "cnpj_ordem": 4, "cnpj_dv": 2, "identificador_matriz_filial": 1,
    "situacao_cadastral": 2, "data_situacao_cadastral": 8, "motivo_situacao_cadastral": 2, "pais": 3,
    "data_inicio_atividade": 8, "cnae_fiscal": 7, "cep": 8, "uf": 2, "municipio": 7,
    "data_situacao_especial": 8,
}
_PARTNER_LENGTHS = {
    "cnpj_basico": 8, "identificador_socio": 1, "qualificacao_socio": 2, "data_entrada_sociedade": 8,
    "pais": 3, "qualificacao_representante": 2, "faixa_etaria": 1,
}
_TAX_REGIME_LENGTHS = {
    "cnpj_basico": 8, "opcao_pelo_simples": 1, "data_opcao_simples": 8, "data_exclusao_simples": 8,
    "opcao_pelo_mei": 1, "data_opcao_mei": 8, "data_exclusao_mei": 8,
}
# Code tables as (name, file-name aliases, code length).
_CODE_TABLES = (
    ("cnaes", ("Cnaes", "CNAECSV"), 7),
    ("municipios", ("Municipios", "MUNICCSV"), 7),
    ("naturezas", ("Naturezas", "NATJUCSV"), 4),
    ("qualificacoes", ("Qualificacoes", "QUALSCSV"), 2),
    ("motivos", ("Motivos", "MOTICSV"), 2),
    ("paises", ("Paises", "PAISCSV"), 3),
    ("portes", ("Portes", "PORTECSV"), 2),
)

# Names of tables, parts of file names that tell them, load policies.
EMPRESAS = Layout("empresas", _COMPANY, ("Empresas", "EMPRECSV"), MERGE, ("cnpj_basico",), _COMPANY_LENGTHS)
ESTABELECIMENTOS = Layout(
    "estabelecimentos", _BRANCH, ("Estabelecimentos", "ESTABELE"), MERGE,
    ("cnpj_basico", "cnpj_ordem", "cnpj_dv"), _BRANCH_LENGTHS,
)
SOCIOS = Layout("socios", _PARTNER, ("Socios", "SOCIOCSV"), REPLACE, (), _PARTNER_LENGTHS)
SIMPLES = Layout(
    "simples", _TAX_REGIME, ("Simples", "SIMPLES"), REPLACE_KEYED, ("cnpj_basico",), _TAX_REGIME_LENGTHS
)
CODE_TABLES = tuple(
    Layout(name, ("codigo", "descricao"), aliases, LOOKUP, ("codigo",), {"codigo": width})
    for name, aliases, width in _CODE_TABLES
)

LAYOUTS: dict[str, Layout] = {t.name: t for t in (EMPRESAS, ESTABELECIMENTOS, SOCIOS, *CODE_TABLES, SIMPLES)}

# Name parts of the archives a monthly drop consists of.
WANTED_ARCHIVES = (
    "Empresas", "Estabelecimentos", "Socios", "Simples", "Cnaes", "Municipios", "Naturezas", "Qualificacoes",
    "Motivos", "Paises",
)

STAMP_COLUMNS = ("run_key", "created_at", "updated_at")
STAMP_FIELDS = [
    T.StructField("run_key", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
]


def stamped_schema(layout: Layout) -> T.StructType:
    """Layout columns followed by the audit stamps."""
    return T.StructType(list(layout.schema.fields) + STAMP_FIELDS)
