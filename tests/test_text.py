from lettora.functions import text


def test_format_zipcode(values):
    inputs = ["1234AB", "1234 AB", "1234", "12345", "", None, "abcdefg", "1234 A"]
    assert values(text.format_zipcode, inputs) == [
        "1234 AB", "1234 AB", "1234", None, None, None, "abcdefg", "1234  A",
    ]


def test_pc4(values):
    assert values(text.pc4, ["x12345", "abc", None, "12 3456"]) == ["1234", "", None, "3456"]


def test_rent_amount(values):
    inputs = ["€ 1200,-", "€ 1,200", "€1.250 Utilities incl.", "$ 5", None, "€ ", "from €950"]
    assert values(text.rent_amount, inputs) == [1200.0, 1.0, 1.0, None, None, None, 950.0]


def test_rent_pattern_is_a_parameter(values):
    assert values(lambda c: text.rent_amount(c, r"\$\s*(\d+)"), ["$ 5", "€ 5"]) == [5.0, None]


def test_area_amount(values):
    assert values(text.area_amount, ["50 m2", "unknown", None, "ca. 60,5"]) == [50.0, None, None, 60.0]


def test_utilities_included(values):
    inputs = ["€1.250 Utilities incl.", "€ 1200", None, "utilities incl."]
    assert values(text.utilities_included, inputs) == [True, False, None, False]


def test_to_double_never_raises(values):
    assert values(text.to_double, ["$100", "", "1e2", " 7 ", None, "12.5"]) == [None, None, 100.0, 7.0, None, 12.5]


def test_blank_to_null(values):
    assert values(text.blank_to_null, ["  ", "", " a ", None]) == [None, None, "a", None]
