import pytest
from pyspark.sql import functions as F

from balcao.operators import contract
from balcao.sources import raw
from tests.conftest import INSTANTE, TRES_VENDAS, envelope, land, rows, sale


def checked(spark, raiz, dia="2026-01-08"):
    return contract.check(raw.parse(raw.scan(spark, f"{raiz}/raw", dia, dia)))


def test_accepts_valid_and_empty_files(spark, tmp_path):
    land(tmp_path, envelope(TRES_VENDAS))
    land(tmp_path, envelope([], turno="TARDE"))
    assert rows(checked(spark, tmp_path), "erros") == [([],), ([],)]


def test_checksum_over_accents_nulls_numbers_and_text(spark, tmp_path):
    numeros = [sale(valor_unitario=800.0, custo_unitario=500, desconto_valor=12.5, desconto_percentual=5.0)]
    canonico = [sale(valor_unitario="800.0", custo_unitario="500", desconto_valor="12.5", desconto_percentual="5.0")]
    doc = envelope(numeros)
    doc["checksum"] = envelope(canonico)["checksum"]
    land(tmp_path, doc)
    espacos = [sale(cliente_nome='  José "Zé" da Silva\\ ', motivo_cancelamento=None)]
    doc2 = envelope(espacos, turno="NOITE")
    doc2["checksum"] = envelope([sale(cliente_nome='José "Zé" da Silva\\')])["checksum"]
    land(tmp_path, doc2)
    grande = [sale(valor_unitario=12345678.9, quantidade=1, desconto_valor="0.00")]
    doc3 = envelope(grande, turno="TARDE")
    doc3["checksum"] = envelope([sale(valor_unitario="12345678.9", desconto_valor="0.00")])["checksum"]
    land(tmp_path, doc3)
    assert rows(checked(spark, tmp_path), "erros") == [([],)] * 3


@pytest.mark.parametrize(
    ("mudanca", "erro"),
    [
        ({"schema_version": "2.0"}, "schema_version"),
        ({"origem": "outro"}, "origem"),
        ({"loja_id": 9}, "loja_id"),
        ({"estado": "SPX"}, "estado"),
        ({"turno": "MADRUGADA"}, "turno"),
        ({"pipeline_id": "x"}, "pipeline_id"),
        ({"quantidade_registros": 7}, "contagem_divergente"),
        ({"checksum": "0" * 64}, "checksum_invalido"),
        ({"checksum": "abc"}, "checksum"),
        ({"data_geracao": "ontem"}, "data_geracao"),
        ({"vendas": None}, "vendas"),
    ],
)
def test_envelope_rules(spark, tmp_path, mudanca, erro):
    land(tmp_path, envelope(TRES_VENDAS) | mudanca, nome="f.json")
    ((erros,),) = rows(checked(spark, tmp_path), "erros")
    assert erro in erros


@pytest.mark.parametrize(
    ("mudanca", "erro"),
    [
        ({"id_venda": "V1"}, "venda.id_venda"),
        ({"loja_id": 6}, "venda.loja_id"),
        ({"cliente_segmento": "OUTRO"}, "venda.cliente_segmento"),
        ({"quantidade": 0}, "venda.quantidade"),
        ({"quantidade": 1.5}, "venda.quantidade"),
        ({"valor_unitario": "x"}, "venda.valor_unitario"),
        ({"desconto_percentual": "26"}, "venda.desconto_percentual"),
        ({"desconto_valor": "200.02"}, "venda.desconto_acima_do_limite"),
        ({"parcelas": 25}, "venda.parcelas"),
        ({"data_venda": "nunca"}, "venda.data_venda"),
        ({"status": "DEVOLVIDA"}, "venda.status"),
        ({"status": "CANCELADA"}, "venda.cancelada_sem_motivo"),
        ({"motivo_cancelamento": "x"}, "venda.motivo_sem_cancelamento"),
        ({"loja_id": 2}, "venda_de_outra_loja"),
    ],
)
def test_sale_rules(spark, tmp_path, mudanca, erro):
    land(tmp_path, envelope([sale(**mudanca), TRES_VENDAS[1]]))
    ((erros,),) = rows(checked(spark, tmp_path), "erros")
    assert erro in erros


def test_discount_limit_is_inclusive(spark, tmp_path):
    land(tmp_path, envelope([sale(desconto_valor="200.01", desconto_percentual="25")]))
    assert rows(checked(spark, tmp_path), "erros") == [([],)]


@pytest.mark.parametrize(
    ("bruto", "canonico"),
    [
        ({"quantidade": 1.0, "parcelas": "2"}, {"quantidade": 1, "parcelas": 2}),
        ({"cliente_nome": "\tAna Prado\n", "categoria": "\u00a0Livros\u2003"}, {"cliente_nome": "Ana Prado", "categoria": "Livros"}),
        ({"data_venda": "2026-01-08T10:30"}, {"data_venda": "2026-01-08T10:30:00"}),
        ({"data_venda": "2026-01-08"}, {"data_venda": "2026-01-08T00:00:00"}),
        ({"data_venda": "2026-01-08 10:30:00.5"}, {"data_venda": "2026-01-08T10:30:00.500000"}),
        ({"data_venda": "2026-01-08T10:30:00.000000"}, {"data_venda": "2026-01-08T10:30:00"}),
        ({"data_venda": "2026-01-08T10:30:00-0300"}, {"data_venda": "2026-01-08T10:30:00-03:00"}),
        ({"data_venda": "2026-01-08T10:30:00+00:00"}, {"data_venda": "2026-01-08T10:30:00Z"}),
    ],
)
def test_checksum_is_taken_over_the_read_values(spark, tmp_path, bruto, canonico):
    doc = envelope([sale(**bruto)]) | {"checksum": envelope([sale(**canonico)])["checksum"]}
    land(tmp_path, doc)
    c = checked(spark, tmp_path)
    assert rows(c, "erros") == [([],)]
    linha = contract.flatten(contract.accepted(c), INSTANTE).first()
    assert linha["quantidade"] == 1 and linha["data_venda"] is not None
    for campo in ("cliente_nome", "categoria"):
        assert linha[campo] == sale(**canonico)[campo]


def test_one_bad_file_does_not_stop_the_others(spark, tmp_path):
    land(tmp_path, envelope(TRES_VENDAS))
    ruim = land(tmp_path, "{ isto não é json", nome="vendas_1_20260108_noite.json")
    c = checked(spark, tmp_path)
    bronze = contract.flatten(contract.accepted(c), INSTANTE)
    assert rows(contract.rejected(c), "erro") == [("json_ilegivel",)]
    assert contract.rejected(c).first()["arquivo_origem"].endswith(ruim)
    assert bronze.count() == 3
    assert rows(bronze.select("estado", "posicao").orderBy("posicao"), "estado", "posicao")[0] == ("SC", 0)
    contagem = contract.counts_by_store(bronze, raw.store_list(spark))
    assert rows(contagem, "loja_id", "registros") == [(1, 3), (2, 0), (3, 0), (4, 0), (5, 0)]


def test_scan_prunes_folders_and_tolerates_absence(spark, tmp_path):
    assert raw.scan(spark, f"{tmp_path}/raw", "2026-01-08", "2026-01-08").count() == 0
    land(tmp_path, envelope([]))
    land(tmp_path, envelope([], loja_id=2), loja=2)
    land(tmp_path, envelope([]), dia="2026-01-09")
    um = raw.scan(spark, f"{tmp_path}/raw", "2026-01-08", "2026-01-08", [1])
    assert um.count() == 1
    assert "PartitionFilters: [" in um._jdf.queryExecution().toString()
    disp = raw.availability(raw.scan(spark, f"{tmp_path}/raw", "2026-01-08", "2026-01-08"), raw.store_list(spark))
    assert rows(disp, "arquivos", "disponivel")[:3] == [(1, True), (1, True), (0, False)]
    assert raw.any_available(disp).first()[0] is True


def test_profile_counts_sales_per_shift(spark, tmp_path):
    land(tmp_path, envelope(TRES_VENDAS))
    land(tmp_path, envelope([], turno="TARDE"))
    perfil = raw.profile(raw.parse(raw.scan(spark, f"{tmp_path}/raw", "2026-01-08", "2026-01-08")))
    assert rows(perfil, "turno", "registros") == [("MANHA", 3), ("TARDE", 0)]


def test_reference_files(catalogo):
    orcamentos = catalogo.budgets().select("ano_base", "loja_id", F.col("receita_mensal").cast("int").alias("r"))
    assert rows(orcamentos.orderBy("loja_id"), "ano_base", "loja_id", "r")[:2] == [(2026, 1, 500000), (2026, 2, 300000)]
    assert rows(catalogo.seed_parameters().where("loja_id > 3").orderBy("loja_id"), "margem_bruta_orcada") == [(39,), (41,)]
    loja = catalogo.stores().where("loja_id = 2").first()
    assert (loja["loja_nome"], str(loja["data_abertura"]), loja["ativa"]) == ("Casa da Serra", "2012-02-01", True)
    assert rows(catalogo.products().orderBy("produto_id"), "produto_id", "margem_alvo_pct")[1] == (902, 55)
