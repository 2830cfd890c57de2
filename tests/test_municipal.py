import pytest

from matchwright.plans import municipal

REGISTRY = [
    (1, "Penha", "SC", 1.0),
    (2, "Embu das Artes", "SP", 1.0),
    (3, "Gavião Peixoto", "SP", 1.0),
    (4, "Balneário Piçarras", "SC", 1.0),
    (5, "Xique-Xique", "BA", 1.0),
    (6, "Santa Bárbara d'Oeste", "SP", 1.0),
    (4314548, "Pinto Bandeira", "RS", 1.0),
]


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(REGISTRY, "MUN_CODE int, MUN_NAME string, UF_ABBREV string, AREA_KM2 double")


@pytest.fixture
def cleaned(spark, registry):
    raw_1 = spark.createDataFrame(
        [
            ("SC", "Penha", 12.0), ("SC", "Penha", 0.0), ("SP", "Embu", 7.0),
            ("SP", "Gavião  Peixoto", 10.0), ("BA", "Xique-Xique", 65.0), ("SP", "Nowhere at all", 1.0),
        ],
        "`UF` string, `Município` string, `Módulo fiscal (ha)` double",
    )
    raw_2 = spark.createDataFrame(
        [
            (0, 1.0, "SC", "PENHA", 12.0), (1, 2.0, "SP", "EMBU DAS ARTES", 5.0),
            (2, 5.0, "BA", "XIQUE-XIQUE", 65.0), (3, 4314530.0, "RS", "PINTO BANDEIRA", 20.0),
            (4, 6.0, "SP", "SANTA BÁRBARA D'OESTE", 10.0), (5, None, None, "Total", None), (6, None, None, None, None),
        ],
        "row int, `Codigo` double, `UF` string, `Municipio` string, `MF (há)` double",
    )
    literal = (
        '{SC:{PENHA:["12"],"BALNEÁRIO PIÇARRAS":["14"]},SP:{"EMBU":["7"],"GAVIÃO PEIXOTO":["10"]},'
        'BA:{"XIQUE-XIQUE":["65"]},RS:{"PINTO BANDEIRA":["20"]}}'
    )
    raw_3 = spark.createDataFrame([(literal,)], "text string")
    return {
        "s1": municipal.clean_source_1(raw_1, registry),
        "s2": municipal.clean_source_2(raw_2, "row"),
        "s3": municipal.clean_source_3(raw_3, "text", registry),
    }


def test_source_1(cleaned, rows):
    columns = ["MUN_NAME", "MUN_NAME_data_orig", "MUN_CODE", "UF_ABBREV", "Modulo_fiscal_ha"]
    out = cleaned["s1"].rows
    assert out.columns == columns
    hits = out.filter("UF_ABBREV IS NOT NULL")
    assert rows(hits) == [
        ("Embu das Artes", "Embu", 2, "SP", 7.0),
        ("Gavião Peixoto", "Gavião  Peixoto", 3, "SP", 10.0),
        ("Penha", "Penha", 1, "SC", 12.0),
        ("Xique-Xique", "Xique-Xique", 5, "BA", 65.0),
    ]
    # corrections that meet no row stay as rows of nulls
    assert out.count() - hits.count() == 7
    assert rows(cleaned["s1"].problems, "MUN_NAME", "MUN_CODE_candidate") == [("Embu", None), ("Nowhere at all", None)]


def test_source_2(cleaned, rows):
    assert rows(cleaned["s2"].rows, "MUN_CODE", "MUN_NAME", "UF_ABBREV", "Modulo_fiscal_ha") == [
        (1, "Penha", "SC", 12.0),
        (2, "Embu Das Artes", "SP", 5.0),
        (4314530, "Pinto Bandeira", "RS", 20.0),
        (5, "Xique-Xique", "BA", 65.0),
        (6, "Santa Bárbara D'Oeste", "SP", 10.0),
    ]
    assert cleaned["s2"].rows.schema["MUN_CODE"].dataType.simpleString() == "int"


def test_source_3(cleaned, rows):
    hits = cleaned["s3"].rows.filter("MUN_CODE IS NOT NULL")
    assert rows(hits, "MUN_NAME", "MUN_NAME_data_orig", "MUN_CODE", "Modulo_fiscal_ha") == [
        ("Balneário Piçarras", "BALNEÁRIO PIÇARRAS", 4, 14),
        ("Embu das Artes", "EMBU", 2, 7),
        ("Gavião Peixoto", "GAVIÃO PEIXOTO", 3, 10),
        ("Penha", "PENHA", 1, 12),
        ("Pinto Bandeira", "PINTO BANDEIRA", 4314548, 20),
        ("Xique-Xique", "XIQUE-XIQUE", 5, 65),
    ]


def test_merge(cleaned, registry, rows):
    with_code = {tag: c.rows.filter("MUN_CODE IS NOT NULL") for tag, c in cleaned.items()}
    final = municipal.merge_sources(with_code["s1"], with_code["s2"], with_code["s3"], registry)
    assert final.columns == ["MUN_CODE", "MUN_NAME", "UF_ABBREV", "Modulo_fiscal_ha"]
    assert rows(final) == [
        (1, "Penha", "SC", 12.0),
        (2, "Embu das Artes", "SP", 5.0),
        (3, "Gavião Peixoto", "SP", 10.0),
        (4, "Balneário Piçarras", "SC", 14.0),
        (4314548, "Pinto Bandeira", "RS", 20.0),
        (5, "Xique-Xique", "BA", 65.0),
        (6, "Santa Bárbara d'Oeste", "SP", 10.0),
    ]
