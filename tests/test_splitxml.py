"""The census of files that are cut into many ranges equals the walk of the whole file."""

import random
from collections import Counter
from xml.etree import ElementTree

import pytest

from listforge.sources import splitxml

ODD = ["<!-- a > b <c> <d x='1'> -->", "<![CDATA[ <x> ]] > </y> ]]>", "<?pi a='>' ?>", "text > with ' and \" ", "<q a='1>2' n:b=\"x > ' y\"/>", "<e/>", "<e />", "<!---->", "é &lt; "]


def whole(text, max_depth):
    seen = Counter()
    stack = [(ElementTree.fromstring(text), "", 1)]
    while stack:
        el, at, depth = stack.pop()
        here = f"{at}/{el.tag.rpartition('}')[2]}"
        seen[here] += 1
        seen.update(f"{here}/@{a.rpartition('}')[2]}" for a in el.attrib)
        stack += [(c, here, depth + 1) for c in el] if depth < max_depth else []
    return seen


def document(rng, size):
    def element(depth):
        name = rng.choice(["a", "b", "n:c", "long-name"])
        attrs = "".join(rng.sample([' x="1"', " y = '>'", ' n:z="\'"', "\n w='a&gt;b'"], rng.randrange(3)))
        inner = "".join(element(depth + 1) if depth < 11 and rng.random() < 0.5 else rng.choice(ODD) for _ in range(rng.randrange(5)))
        return f"<{name}{attrs}>{inner}</{name} >"

    head = "<?xml version='1.0'?>\n<!DOCTYPE root [ <!ENTITY k 'v'> <!ELEMENT a ANY> ]>\n"
    return head + '<root xmlns:n="u" k="v">' + "".join(element(1) for _ in range(size)) + "</root>\n"


@pytest.mark.parametrize("bytes_", ["31", "400", "128m"])
def test_ranges_of_files_count_as_whole_files(spark, tmp_path, bytes_):
    rng = random.Random(7)
    texts = [document(rng, 3), document(rng, 2), "<only/>", "<r>" + "<!-- " + "> x < y " * 12 + "--><k a='" + ">" * 70 + "' b='2'/></r>"]
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.xml").write_text(t)
    keys = {"spark.sql.files.maxPartitionBytes": bytes_, "spark.sql.files.openCostInBytes": "1"}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = {r.path: r.n for r in splitxml.path_census(spark, str(tmp_path), 5).collect()}
        if bytes_ == "31":
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30
    finally:
        for k in keys:
            spark.conf.unset(k)
    want = Counter()
    for t in texts:
        want.update(whole(t, 5))
    assert got == want


@pytest.mark.parametrize("text", ["<a><b></a></b>", "<a>", "</a>", "<a b='></a>", "<a><!-- </a>"])
def test_what_isn_t_nested_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.xml").write_text(text)
    with pytest.raises(Exception, match="nested|ends inside|doesn't end"):
        splitxml.path_census(spark, str(tmp_path)).collect()
