"""Text, entity and extraction rules on literal cases."""

import pytest
from pyspark.sql import functions as F

from evidencepanel.functions import entity as ent
from evidencepanel.functions import extraction as ex
from evidencepanel.functions import grading as gr
from evidencepanel.functions import text as tx
from evidencepanel.operators import candidates as cand
from evidencepanel.operators import ranking as rk


def one(spark, column, value="x"):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("v")).first()["v"]


def test_strip_takes_every_kind_of_space(spark):
    assert one(spark, tx.strip("t"), "　\x1c a b \t\n") == "a b"
    assert one(spark, tx.is_blank("t"), "  \x85") is True
    assert one(spark, tx.is_blank("t"), None) is True


def test_number_and_year_parsing(spark):
    assert one(spark, tx.to_int("t"), " 2023 ") == 2023
    assert one(spark, tx.to_int("t"), "2023.0") is None
    assert one(spark, tx.to_number("t"), "1.5e3") == 1500.0
    assert one(spark, tx.to_number("t"), "1.5d") is None
    assert one(spark, tx.year_key("t"), " 002023") == "2023"
    assert one(spark, tx.year_key("t"), "000") == "0"


@pytest.mark.parametrize(
    ("name", "target", "want"),
    [
        ("110000", "short", "北京"),
        ("北京市朝阳区", "short", "北京"),
        ("广西壮族自治区", "code", "450000"),
        ("内蒙古", "full", "内蒙古自治区"),
        ("火星省", "short", None),
    ],
)
def test_normalize_entity(spark, name, target, want):
    assert one(spark, ent.normalize_entity("t", target=target), name) == want


def test_first_prefix_in_dimension_order_wins(spark):
    dim = ent.EntityDim((("N1", "N1 full", "c1"), ("N10", "N10 full", "c10")))
    assert one(spark, ent.normalize_entity("t", dim), "N105") == "N1"
    assert one(spark, ent.normalize_entity("t", dim, "full"), "N10") == "N10 full"
    frame = dim.frame(spark)
    rows = spark.createDataFrame([("N105",), ("N10",), ("c1",), ("zz",), (None,)], "name string")
    got = {r["name"]: r["entity"] for r in ent.normalize_entity_join(rows, "name", frame).collect()}
    assert got == {"N105": "N1", "N10": "N10", "c1": "N1", "zz": None, None: None}


def test_strict_names_have_no_prefix_tier(spark):
    assert one(spark, ent.short_to_full("t"), "北京") == "北京市"
    assert one(spark, ent.full_to_short("t"), "北京市") == "北京"
    assert one(spark, ent.short_to_full("t"), "北京市朝阳区") is None


def test_universe_and_bad_form(spark):
    for form in ("short", "full", "code"):
        assert ent.entity_universe(spark, form=form).count() == 30
    with pytest.raises(ValueError):
        ent.entity_universe(spark, form="other")


def test_aliases(spark):
    rows = spark.createDataFrame([("广西壮族自治区",), ("内蒙古自治区",), ("北京市",), ("火星省",)], "full string")
    got = {r["full"]: r["aliases"] for r in ent.entity_aliases(rows).collect()}
    assert got["广西壮族自治区"] == ["广西", "全省", "我省", "全区", "我区"]
    assert got["内蒙古自治区"] == ["内蒙古", "全区", "我区"]
    assert got["北京市"] == ["北京", "全市", "我市"]
    assert got["火星省"] == ["火星", "全省", "我省"]


def test_sentences_and_domains(spark):
    assert one(spark, tx.split_sentences("t"), "第一句。第二句！ 第三句？；x") == ["第一句。", "第二句！", "第三句？", "；", "x"]
    assert one(spark, tx.extract_domain("t"), "https://u@www.Stats.gov.cn:81/page") == "www.stats.gov.cn"
    assert one(spark, tx.extract_domain("t"), "not a url") == ""
    assert one(spark, tx.extract_domain("t"), "") == ""
    assert one(spark, tx.net_location("t"), "https://A.b:81/page") == "A.b:81"


def test_domain_quality(spark):
    assert one(spark, gr.domain_quality("t"), "https://tjj.hubei.gov.cn/x") >= 8
    assert one(spark, gr.domain_quality("t"), "https://baijiahao.baidu.com/x") < 0
    assert one(spark, gr.domain_quality("t"), "") == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("全省新能源汽车保有量达到123.4万辆", (123.4, "万辆")),
        ("新能源汽车保有量为56789辆", (56789.0, "辆")),
        ("电动汽车的社会保有量约为7万辆", (7.0, "万辆")),
        ("新能源汽车保有量稳步增长", None),
    ],
)
def test_extract_value(spark, text, want):
    got = one(spark, ex.extract_value("t"), text)
    assert (tuple(got) if got else None) == want


def score(spark, sentence, entity="湖北省", url="https://example.com"):
    own = ent.explicit_name(F.lit(entity))
    other, hint = ent.names_other_entity(F.col("t"), own), ent.hinted_url(F.lit(entity), F.lit(url))
    column = ex.score_sentence(F.lit(entity), own, F.col("t"), 2023, other, hint)
    return one(spark, column, sentence)


def test_score_sentence(spark):
    assert score(spark, "截至2023年底，湖北省新能源汽车保有量") == 12
    assert score(spark, "全国新能源汽车保有量") < 0
    assert score(spark, "全市新能源汽车保有量") < 0
    assert score(spark, "湖南新能源汽车保有量") < 0
    assert score(spark, "新能源汽车保有量", url="https://www.hubei.gov.cn") == 2


def test_extract_candidates(spark):
    pages = spark.createDataFrame(
        [
            ("湖北省", "https://a.hubei.gov.cn", "开头。湖北省新能源汽车保有量为500000辆。结尾"),
            ("湖北省", "https://b.example", "新能源汽车保有量为5万辆。"),
            ("湖北省", "https://c.example", "全省新能源汽车保有量为5万辆。"),
            ("湖北省", "https://c.hubei.gov.cn", "全省新能源汽车保有量为5万辆。"),
            ("广东省", "https://d.example", "全省新能源汽车保有量为6万辆。"),
        ],
        "entity string, url string, text string",
    )
    got = {r["url"]: r for r in cand.extract_candidates(pages, 2023).collect()}
    assert set(got) == {"https://a.hubei.gov.cn", "https://c.hubei.gov.cn", "https://d.example"}
    assert got["https://a.hubei.gov.cn"]["value_10k"] == 50.0
    assert got["https://a.hubei.gov.cn"]["sentence_no"] == 1
    assert got["https://c.hubei.gov.cn"]["explicit_province_in_sentence"] is False


def test_dedup_candidates_keeps_best(spark):
    rows = spark.createDataFrame(
        [(0, "u", 1.0, "s", 5), (1, "u", 1.0, "s", 10), (2, "u", 2.0, "s", 3), (3, "v", 2.0, "s", 9), (4, "v", 2.0, "s", 9)],
        "ord int, url string, value_10k double, sentence string, score int",
    )
    got = [(r["ord"], r["score"]) for r in rk.dedup_candidates(rows).orderBy(F.desc("score"), "ord").collect()]
    assert got == [(1, 10), (3, 9), (2, 3)]


def test_schema_overrides(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"required_term": "常住人口", "unit_to_10k": {"万人": 1}, "score_weights": {"year_end": 9}}')
    rules = ex.read_rules(path)
    assert rules.required_term == "常住人口" and rules.unit_to_10k == {"万人": 1.0}
    assert rules.weight("year_end") == 9 and rules.weight("url_hint") == 2
    assert ex.read_rules(None) is ex.VEHICLE_STOCK
    for bad in ({"required_term": 1}, {"any_terms": "x"}, {"unit_to_10k": {}}, {"unit_to_10k": {"a": "b"}}, []):
        with pytest.raises(ValueError):
            ex.rules_from_json(bad)
    with pytest.raises(ValueError, match="required_term.*any_terms"):
        ex.rules_from_json({"required_term": 1, "any_terms": "x"})
    with pytest.raises(FileNotFoundError):
        ex.read_rules(tmp_path / "none.json")


def test_windows_and_snippets(spark):
    long = "a" * 200 + "年末常住人口 123.4 万人" + "b" * 300
    got = one(spark, ex.extract_with_window("t", F.lit(r"常住人口\s*([0-9.]+)\s*万人")), long)
    start = long.index("常住人口")
    assert tuple(got) == ("123.4", long[start - 120 : start + 220])
    near = one(spark, ex.extract_near_token("t", F.lit("x*量([0-9]+)y*"), "量"), "x" * 50 + "量12" + "y" * 60)
    frag = "x" * 50 + "量12" + "y" * 60
    assert tuple(near) == (12.0, frag[50 - 28 : 50 + 40])
    assert one(spark, tx.clean_snippet("t", 4), " a\nbcdef ") == "a bc..."


def test_field_rules(spark):
    rules = ex.parse_field_rules(
        {"fields": [{"name": "n", "patterns": ["x([0-9]+)", "([0-9.]+)"], "cast": "int"}, {"name": "w", "patterns": ["[a-z]+"]}, {"patterns": ["a"]}]}
    )
    got = one(spark, ex.extract_fields("t", rules), "v 12.9  end")
    assert got["n"]["value_num"] == 12.0 and got["n"]["value_str"] is None and got["n"]["pattern"] == "([0-9.]+)"
    assert got["w"]["value_str"] == "v" and got["w"]["value_num"] is None


def test_grades(spark):
    assert [one(spark, gr.norm_level("t"), x) for x in (" a级", "B", "c", "x", "")] == ["A", "B", "C", "B", "B"]
    assert one(spark, gr.suggest_level("t"), "https://www.x.gov.cn/TJGB/1") == "A-候选"
    assert one(spark, gr.suggest_level("t"), "https://www.x.gov.cn/a") == "B-候选"
    assert one(spark, gr.suggest_level("t"), "https://x.com") == "C-候选"
    assert one(spark, gr.host_score("t"), "https://tjj.x.gov.cn") == 10
    assert one(spark, gr.source_name_from_url("t"), "https://a.b/c") == "a.b（2024人口发布）"
