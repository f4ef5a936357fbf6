import pytest
from pyspark.sql import functions as F

from folioframe.operators import essays, layout, leaf_validation as lv
from folioframe.sources.layout import PAGES, placed


def test_markers_out():
    text, places = lv.without_markers("BẾN  ĐÒ[^1] và\nCON TÀU [^2] x")
    assert text == "BẾN ĐÒ và CON TÀU x"
    assert [(text[:p].split()[-1], n) for p, n in places] == [("ĐÒ", 1), ("TÀU", 2)]


def test_score():
    pages = [(1, "Gió thổi mạnh."), (2, "Thuyền trở về. 1 Ghi chú.")]
    cov, raw, markers = lv.score("Gió thổi mạnh. Thuyền[^1] trở về.", [(2, 2, "Ghi chú.")], pages, 1, 2)
    assert cov == 1.0 and 0.9 < raw <= 1.0 and markers == [(2, 1)]
    assert lv.score("x", [], [], 1, 2) == (0.0, 0.0, [])
    assert lv.score("", [], pages, 1, 2)[0] == 0.0


def test_leaves(spark):
    good = "## 1. A\n\nGió thổi mạnh. Thuyền[^1] trở về.\n\n[^1]: (Trang 2) Ghi chú.\n"
    bad = "## 2. B\n\nHoàn toàn khác hẳn[^3].\n"
    files = spark.createDataFrame([("a", good), ("b", bad)], "path string, text string")
    jobs = spark.createDataFrame([("a", 1, 1, 2), ("b", 1, 3, 3), ("c", 1, 4, 4)], "path string, doc_id long, start_page int, end_page int")
    pages = spark.createDataFrame([(1, 1, "Gió thổi mạnh."), (1, 2, "Thuyền trở về. 1 Ghi chú."), (1, 3, "zzz"), (1, 4, "qq")], PAGES)
    notes = spark.createDataFrame([(1, 1, 2, 3, "x")], "doc_id long, num int, page int, end_page int, text string")
    allowed = spark.createDataFrame([("b", "ORPHAN_MARKER:3@3", "known")], "path string, flag string, reason string")
    got = {r["path"]: r for r in lv.validate_leaves(files, jobs, pages, notes, allowed, min_density=5, tasks=2).collect()}
    assert got["a"]["status"] == "OK" and got["a"]["rendered_coverage"] == 1.0
    assert got["b"]["status"] == "REVIEW" and got["b"]["flags"] == ["FOOTNOTE_GAP:1"] and got["b"]["errata"] == ["ORPHAN_MARKER:3@3 - known"]
    assert "NO_FILE" in got["c"]["flags"] and got["c"]["rendered_coverage"] == 0.0
    text = lv.report(lv.validate_leaves(files, jobs, pages, notes, allowed, min_density=5, tasks=2))
    assert "- OK: 1" in text and "- REVIEW: 2" in text and "| a | 1.000 |" in text


@pytest.mark.parametrize(
    ("value", "expected"),
    [("5.NGHỀ ĐÓNG THUYỀN VÙNG BIỂN XA", (5, "NGHỀ ĐÓNG THUYỀN VÙNG BIỂN XA")), ("[6]. NGHỀ ĐÓNG THUYềN VÙNG BIỂN XA2", (6, "NGHỀ ĐÓNG THUYềN VÙNG BIỂN XA")), ("5. Nghề đóng", None), ("VII. SÔNG NƯỚC", None)],
)
def test_essay_heading(spark, value, expected):
    got = spark.createDataFrame([(value,)], "x string").select(essays.essay_heading(F.col("x")).alias("h")).head()["h"]
    assert (tuple(got) if got else None) == expected


def test_essays(spark):
    rows = [(1, 100, "PHẦN THỨ BA"), (1, 130, "NHẬN ĐỊNH"), (1, 200, "Lời dẫn."), (1, 300, "I. TỔNG QUAN"), (1, 330, "1. BÀI MỘT RẤT"), (1, 350, "DÀI"), (1, 400, "Nội dung một."), (2, 100, "Tiếp một."), (2, 300, "2. BÀI HAI"), (2, 350, "Nội dung hai."), (3, 100, "3. BÀI BA"), (4, 100, "Nội dung ba.")]
    spans, drawings = placed(spark, [(1, p, 99, y, s, "Times-Roman", 13.7) for p, y, s in rows])
    parts = spark.createDataFrame([(1, 3, 1, 4, ["I"])], "doc_id long, part int, start_page int, end_page int, romans array<string>")
    got = essays.leaves(layout.lines(spans, drawings), parts).orderBy("start_page", "body_top").collect()
    assert [(r["kind"], r["roman"], r["number"], r["title"], r["start_page"], r["end_page"], r["body_bottom"] is None) for r in got] == [
        ("introduction", None, None, None, 1, 1, False), ("essay", "I", 1, "BÀI MỘT RẤT DÀI", 1, 2, False), ("essay", "I", 2, "BÀI HAI", 2, 2, True), ("essay", "I", 3, "BÀI BA", 3, 4, True),
    ]
