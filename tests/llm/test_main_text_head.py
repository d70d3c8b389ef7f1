import time

import pytest

from pressloom.llm import main_text


def test_open_head_ends_where_the_body_starts():
    read = lambda page: [b.text for b in main_text.blocks(page)]
    head = "<html><head><meta charset=utf-8><title>t</title><style>x</style>"
    assert read(head + "<body><article><p>Hello</p></article></body></html>") == ["Hello"]
    assert read(head + "<p>Hello<p>you") == ["Hello", "you"]
    assert read(head + " \n Hello <b>you</b>") == ["Hello you"]
    assert read(head + "<a href=x>Hello</a>") == ["Hello"]
    assert read(head + "<noscript>no<body><p>Hello</p>") == ["Hello"]
    assert read(head + "<template><p>no</p></template><link href=x></head><body>Hello</body>") == ["Hello"]
    assert read("<head><title>t</title></head><body>Hello") == ["Hello"]


@pytest.mark.parametrize("unit", ["<i>x</b>", "<b><div><i>x</b>", "<li><ul><div>x</li>", "<i>x<div></div>", "<template><head><body>", "<td>x", "<div>x"])
def test_work_grows_with_the_page(unit):
    """Eight times the malformed page takes some eight times as long."""
    took = []
    for count in (2_000, 16_000):
        began = time.process_time()
        main_text.blocks(unit * count)
        took.append(time.process_time() - began)
    assert took[1] < 25 * took[0] + 0.2


def test_whole_text_of_a_deep_page():
    found = main_text.blocks("<div class=a>x" * 500)
    assert [b.text for b in found] == ["x"] * 500 and max(len(b.path) for b in found) <= 3 * main_text.PATH_DEPTH
    assert [b.depth for b in found] == list(range(1, 501))


def test_fitting_takes_whole_blocks(spark, monkeypatch):
    told = []
    monkeypatch.setattr(main_text, "train", lambda examples: told.append(list(examples)))
    long = "word " * 300 + "end"
    html = "".join(f"<p>{k} {long}</p>" for k in range(60))
    monkeypatch.setattr(main_text, "examples", lambda texts: texts)
    main_text.fit(spark.createDataFrame([(1, html)], "page_id long, html string"))
    assert told == [[f"{k} {long}" for k in range(60)]]
