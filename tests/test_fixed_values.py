"""Bands, rooms, labels and header names as they have to be, at and beside their limits."""

import pytest
from pyspark.sql import functions as F

from tessela.operators import segments
from tessela.sources import schema

INF = float("inf")
LEFT = [(-1, ""), (0, "<75"), (74.9, "<75"), (75, "75-90"), (90, "90-130"), (130, "130-160"), (160, "160-200"), (200, "200-400"), (400, "400-600"), (600, "600-800"), (800, "800-1000"), (999.9, "800-1000"), (1000, ">1000"), (10_000_000, ""), (None, "")]
APARTMENT = [(-1, None), (0, "<50"), (50, "<50"), (50.1, "50-75"), (75, "50-75"), (90, "75-90"), (130, "90-130"), (160, "130-160"), (200, "160-200"), (200.1, ">200"), (450, ">200"), (INF, ">200"), (None, None)]
HOUSE = [(0, "<400"), (400, "<400"), (600, "400-600"), (800, "600-800"), (1000, "800-1000"), (1001, ">1000"), (None, None)]
ROOMS = [(0, "1"), (1, "1"), (2, "2"), (4, "4"), (5, "+5"), (9, "+5"), (None, None)]
ROOMS_HOUSE = [(0, "Até 4"), (4, "Até 4"), (5, "5 ou mais"), (None, None)]


@pytest.mark.parametrize(
    ("cases", "band"),
    [
        (LEFT, lambda c: segments.band_left(c, segments.AREA_LEFT, segments.AREA_LEFT_END)),
        (APARTMENT, lambda c: segments.band_right(c, segments.AREA_APARTMENT)),
        (HOUSE, lambda c: segments.band_right(c, segments.AREA_HOUSE)),
        (ROOMS, segments.rooms_apartment),
        (ROOMS_HOUSE, segments.rooms_house),
    ],
)
def test_bands(spark, cases, band):
    df = spark.createDataFrame([(i, None if x is None else float(x)) for i, (x, _) in enumerate(cases)], "i int, x double")
    assert [r["b"] for r in df.select("i", band(F.col("x")).alias("b")).orderBy("i").collect()] == [label for _, label in cases]


def test_legacy_bands_leave_out_zero(spark):
    assert spark.range(1).select(segments.band_right(F.lit(0.0), segments.AREA_APARTMENT, lowest=False).alias("b")).first()["b"] is None


@pytest.mark.parametrize(("header", "name"), [("Setor", "bairro"), ("ID_Anuncio", "codigo"), ("finalidade", "oferta"), ("negócio", "oferta"), ("Valor Total", "preco"), ("area_privativa", "area_util"), ("dorms", "quartos"), ("qtde vagas", "vagas"), ("vlm2", "valor_m2"), ("Q", "quadra"), ("CEP", "cep"), ("dt", "data")])
def test_headers(spark, header, name):
    assert schema.standardised(spark.createDataFrame([("x",)], f"`{header}` string")).columns == [name]
