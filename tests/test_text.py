import pytest
from pyspark.sql import functions as F

from folioframe.functions import text as t


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).head()["y"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [("Ông lái kể: -", ["Ông lái kể:", "-"]), ("", []), ('- "Ai gọi đò?". Sóng vỗ.', ['- "Ai gọi đò?".', "Sóng vỗ."]), ("She cried: - Row. - Wait.", ["She cried:", "- Row.", "- Wait."])],
)
def test_split_dialogues(spark, value, expected):
    assert one(spark, value, t.split_dialogues) == expected


@pytest.mark.parametrize(("value", "expected"), [("-", False), ('- "Đò đầy rồi', False), ('- "Ai gọi đò?".', True), ("Ông lái kể:", True), ('- "Chờ tôi với!"', True), ("cập bến.[^8]", True), (None, None)])
def test_ends_sentence(spark, value, expected):
    assert one(spark, value, t.ends_sentence) is expected


@pytest.mark.parametrize(("value", "expected"), [("(Tiếp theo)", True), ("( Tiếp theo )", True), ("(Tiếp theo) Sáng hôm ấy", False), ("Tiếp theo là mùa gió.", False)])
def test_continuation(spark, value, expected):
    assert one(spark, value, t.is_continuation_marker) is expected


@pytest.mark.parametrize(("value", "expected"), [("1", "[^1]"), ("1. ", "[^1]. "), ("2.", "[^2]."), (" 3,", " [^3],"), ("a", None), ("1a", None), ("", None)])
def test_superscript_marker(spark, value, expected):
    assert one(spark, value, t.superscript_marker) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [("a  b ,c", "a b,c"), ("“ x ”", "“x”"), ("thuyền- bè", "thuyền-bè"), ("-Chèo", "- Chèo"), ("-", "-"), ("ñò Ðỏ", "đò Đỏ"), ("''x''", '"x"'), ("x\xa0y\xad​", "x y")],
)
def test_clean_spaces(spark, value, expected):
    assert one(spark, value, t.clean_spaces) == expected


def test_headings(spark):
    assert one(spark, "42. BẾN ĐÒ XƯA3", t.clean_story_title).asDict() == {"number": 42, "title": "BẾN ĐÒ XƯA"}
    assert one(spark, "42. Bến đò", t.clean_story_title) is None
    assert one(spark, "VI - SÔNG NƯỚC 5", t.clean_category_title)["title"] == "VI. SÔNG NƯỚC"
    assert one(spark, "VI. Sông nước", t.clean_category_title) is None


def test_slug_fold(spark):
    assert one(spark, "Bến  Đò Cửa-lò!", t.slug) == "Ben_Do_Cua_lo"
    assert one(spark, "Đò CỬA", t.folded) == "do cua"


def test_caps(spark):
    assert one(spark, "123", t.is_all_caps) is False
    assert one(spark, "ĐÒ 1", t.is_all_caps) is True
    assert one(spark, "123", t.caps_ratio) is None


@pytest.mark.parametrize(
    ("title", "printed", "expected"),
    [("BẾN ĐÒ XƯA", "42. BẾN ĐÒ XƯA[^1]", "BẾN ĐÒ XƯA[^1]"), ("GIÓ TO", "8. GIÓ TO [^4]", "GIÓ TO[^4]"), ("SÓNG", "9. SÓNG[^2][^5]", "SÓNG[^2][^5]"), ("A B", "1. A[^1] C", "A B"), ("A B", "1. A[^1] B", "A[^1] B"), ("A", "1. A", "A")],
)
def test_heading_with_markers(title, printed, expected):
    assert t.heading_with_markers(title, printed) == expected


def test_pdf_needs_a_library(spark, tmp_path):
    from importlib.util import find_spec

    from folioframe.sources import pdf

    if find_spec("fitz") is None:
        (tmp_path / "a.pdf").write_text("x")
        with pytest.raises(Exception, match="no PDF library here"):
            pdf.read_pdf(spark, str(tmp_path)).count()
