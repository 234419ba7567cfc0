import pytest

from tickloom.llm import licences as li


def plain(text):
    """Best template of a segment, by comparing with all."""
    bag = li.bigrams(text)
    found = []
    for name, t in li.TEMPLATES:
        own = li.bigrams(t)
        total = sum(bag.values()) + sum(own.values())
        dice = 2.0 * sum((bag & own).values()) / total if total else 0.0
        if dice >= li.THRESHOLD:
            found.append((-dice, name))
    return (min(found)[1], -min(found)[0]) if found else None


TEXTS = [
    *(t for _, t in li.TEMPLATES), "licensed under the APACHE license version 2.0", "Licensed under CC BY-NC-SA 4.0.", "all rights reserved worldwide", "All rights",
    "", "word", "This work is licensed under the GNU General Public License, version 4.", "Released under the MIT License. " * 2, "é rights reserved", "all rights reserved all rights reserved",
]


@pytest.mark.parametrize("text", TEXTS)
def test_pruning_loses_nothing(text):
    known = li.Templates(li.TEMPLATES, li.THRESHOLD)
    assert known.match(text) == plain(text)
    if plain(text):
        assert known.candidates(["x y z", text]).tolist() == [1]


def test_every_notice_is_known():
    known = li.Templates(li.TEMPLATES, li.THRESHOLD)
    assert all(known.match(t) == (name, 1.0) for name, t in li.TEMPLATES)


def test_documents(spark):
    wrapped = li.TEMPLATES[2][1].replace(" software", "\nsoftware").replace(" WITHOUT", "\nWITHOUT")
    rows = [
        (1, "text before\nReleased under the MIT License.\nand after\nAll rights reserved.", "own", 1),
        (2, f"a title\n\n{wrapped}\n \nmore", "own", 1), (3, None, "own", 1), (4, "", None, 1), (5, "nothing here " * 9000, None, 1), (None, "all rights reserved", None, 1),
    ]
    got = li.scan(spark.createDataFrame(rows, "doc_id long, text string, license string, notices int")).collect()
    assert [(r.doc_id, r.license, r.dice, [n.license for n in r.notices]) for r in got] == [
        (1, "MIT", 1.0, ["MIT", "Proprietary"]), (2, "Apache-2.0", 1.0, ["Apache-2.0"]), (3, "", 0.0, []), (4, "", 0.0, []), (5, "", 0.0, []), (None, "Proprietary", 1.0, ["Proprietary"]),
    ]
    assert li.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
