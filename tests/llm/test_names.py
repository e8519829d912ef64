import pytest

from gavelspark.llm import names as N


@pytest.mark.parametrize(
    ("typed", "first", "middle", "last", "suffix", "used", "reads"),
    [
        ("Petra Hélène Belordell", "Petra", "Hélène", "Belordell", None, None, True),
        ("BELORDELL, P.", "Petra", "Hélène", "Belordell", None, None, True),
        ("P.H. Belordell", "Petra", "Hélène", "Belordell", None, None, True),
        ("The Hon. Belordell", "Petra", None, "Belordell", None, None, True),
        ("Ansel Belordell", "Petra", None, "Belordell", None, None, False),
        ("Renzo Ulundcore (D-5)", "Renzo", None, "Ulundcore", None, None, True),
        ("De-La-Yaramdane C", "Chidi", None, "de la Yaramdane", None, None, True),
        ("O DRINUZEN, ROBERT", "Robert", None, "O'Drinuzen", None, None, True),
        ("Robert O’Drinuzen", "Robert", None, "O'Drinuzen", None, None, True),
        ("Bobby ODrlnuzen", "Robert", None, "O'Drinuzen", None, None, True),
        ("Keiko YÃ¡ruston", "Keiko", None, "Yáruston", None, None, True),
        ("Dot Ardorman", "Dorothy", None, "Ardorman", None, "Dot", True),
        ("Zachary Belarleth Jr.", "Zachary", None, "Bélarleth", None, None, False),
        ("Zachary Belarleth Jr.", "Zachary", None, "Bélarleth", "Jr.", None, True),
        ("", "Petra", None, "Belordell", None, None, False),
        (None, "Petra", None, "Belordell", None, None, False),
        ("?", "Petra", None, "Belordell", None, None, False),
    ],
)
def test_readings(typed, first, middle, last, suffix, used, reads):
    cost = N.reading_cost(N.parse(typed), N.person(first, middle, last, suffix, used))
    assert (cost is not None) == reads


def test_the_right_relative_is_cheapest():
    people = [N.person("Dorothy", "Aoife", "Ardorman", None, "Dot"), N.person("Josephine", "Chidi", "Ardorman", None, None)]
    assert N.reading_cost(N.parse("Ardorman J"), people[0]) is None
    assert N.reading_cost(N.parse("D.A. Ardorman*"), people[1]) is None


def test_key_sets():
    x = N.parse_keys(["radosbry", "e", "radosbrye"])
    assert sorted(x.tokens) == ["e", "radosbry"]
    assert N.reading_cost(x, N.person("Esme", None, "Radosbry", None, None)) is not None
    assert N.parse_keys(None).tokens == [] and N.parse_keys([]).tokens == []


def test_committees():
    like = lambda a, b: N.committee_likeness(N.committee_words(a), N.committee_words(b), lambda w: 1.0)
    assert like("Committee on Insurance / Long Term Care", "Long Term Care & Insurance, Cmte. on") == 1
    assert like("Cmte on Insu.", "Insurance Committee") > 0.6
    assert like("Trnst", "Transit") > 0.6
    assert N.committee_likeness(("rbles",), N.committee_words("Rural Broadband, Libraries and Emergency Services"), lambda w: 1.0) > 0.6
    assert like("Insurance", "Insurance and Ethics") == 0
    assert like("", "Insurance") == 0


def test_edits():
    assert N.edits("abcd", "acbd") == 1 and N.edits("a", "abcd") == 3 and N.edits("abcdef", "ghijkl") == 4
