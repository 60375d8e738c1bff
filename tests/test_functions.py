"""Column expressions on their edge cases."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kontor.functions import calendar, survey, text
from kontor.operators.columns import since

NAMESPACE = survey.INDIVIDUAL_NAMESPACE


def mapped(frame, expression, inputs, kind="STRING"):
    df = frame([(i, value) for i, value in enumerate(inputs)], f"i INT, x {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_income_midpoint(frame):
    cases = {
        "0-25000": 12500.0, "$25,001-50000": 37500.5, "Greater than 100000": 130000.0,
        " greater than $1": 130000.0, "10 - 20": 15.0, "1-2-3": 1.5, "abc": None, "-5": None,
        "1.5-2": None, "": None, "7": None, None: None,
    }
    assert mapped(frame, text.income_midpoint, cases) == list(cases.values())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=50))
def test_income_midpoint_of_any_band(frame, bands):
    found = mapped(frame, text.income_midpoint, [f"${low:,}-{high:,}" for low, high in bands])
    assert found == [(low + high) / 2 for low, high in bands]


def test_business_type_and_frequency(frame):
    codes = [" OS ", "BS", "BM", "ZZ", None]
    assert mapped(frame, text.business_type, codes) == [
        "Warehouse", "Specialty Bike Shop", "Value Added Reseller", "ZZ", None]
    assert mapped(frame, text.order_frequency, codes) == ["Q", "A", "S", None, None]


def test_money(frame):
    assert mapped(frame, text.money, ["$1,000.5", "7", "none", "", None]) == [1000.5, 7.0, None, None, None]


def test_full_name(frame):
    df = frame([("A", None), (None, None), ("A", "B")], "a STRING, b STRING")
    names = [row[0] for row in df.select(text.full_name(F.col("a"), F.col("b"))).collect()]
    assert names == ["A ", " ", "A B"]


def test_normalized_and_labels(frame):
    assert mapped(frame, text.normalized, [" Seattle\t", None]) == ["seattle", None]
    df = frame([(2001, 3)], "y INT, q INT")
    row = df.select(text.quarter_label(F.col("y"), F.col("q")),
                    text.month_label(F.col("y"), F.lit("May"))).first()
    assert tuple(row) == ("2001-Q3", "2001-May")


def test_semester(frame):
    assert mapped(frame, calendar.semester, [1, 2, 3, 4], "INT") == [1, 1, 2, 2]


def test_day_and_month_names(frame):
    day = [dt.date(2005, 1, 1)]
    assert mapped(frame, calendar.day_name, day, "DATE") == ["Saturday"]
    assert mapped(frame, lambda c: calendar.day_name(c, "spanish"), day, "DATE") == ["Sábado"]
    assert mapped(frame, lambda c: calendar.month_name(c, "french"), day, "DATE") == ["Janvier"]
    # A language without names falls back to English.
    assert mapped(frame, lambda c: calendar.day_name(c, "latin"), day, "DATE") == ["Saturday"]


def test_timestamp_or_null(frame):
    assert mapped(frame, calendar.timestamp_or_null, ["1999-01-05", "unknown", None]) == [
        dt.datetime(1999, 1, 5), None, None]


def test_since(frame):
    df = frame([(1, dt.date(2020, 1, 1)), (2, dt.date(2021, 1, 1))], "i INT, modifieddate DATE")
    assert [row.i for row in since(df, dt.date(2021, 1, 1)).collect()] == [2]
    assert since(df).count() == 2


def individual(frame, *documents):
    df = frame([(i, document) for i, document in enumerate(documents)], "i INT, x STRING")
    return survey.with_individual_survey(df, "x").orderBy("i").collect()


def test_individual_survey(frame):
    whole = f'<IndividualSurvey xmlns="{NAMESPACE}">{{}}</IndividualSurvey>'
    rows = individual(
        frame,
        whole.format("<BirthDate>1966-04-08Z</BirthDate><Gender>M</Gender><Gender>F</Gender>"),
        whole.format("<Occupation></Occupation><Education/><MaritalStatus>S &amp; M</MaritalStatus>"),
        whole.format("<BirthDate>1966</BirthDate>")[:-4],
        "<IndividualSurvey><BirthDate>1966</BirthDate></IndividualSurvey>",
        whole.format("<Home><BirthDate>1966</BirthDate></Home>"),
        "no xml", "", None,
    )
    assert (rows[0].birthdate, rows[0].gender, rows[0].maritalstatus) == ("1966-04-08Z", "M", None)
    assert (rows[1].englishoccupation, rows[1].englisheducation) == ("", "")
    assert rows[1].maritalstatus == "S & M"
    for row in rows[2:]:
        assert all(row[name] is None for name in survey.INDIVIDUAL_FIELDS.values())


def test_individual_survey_namespaces(frame):
    foreign = "<IndividualSurvey xmlns='urn:other'><BirthDate>1966</BirthDate></IndividualSurvey>"
    rows = individual(
        frame,
        f'<IndividualSurvey xmlns="{NAMESPACE}"><birthdate>1</birthdate></IndividualSurvey>',
        foreign.replace("</", f"<!-- {NAMESPACE} --></", 1),
        f'<IndividualSurvey xmlns="{NAMESPACE}/2"><BirthDate>1</BirthDate></IndividualSurvey>',
        f'<IndividualSurvey xmlns="{NAMESPACE}"><o:BirthDate xmlns:o="urn:o">1</o:BirthDate></IndividualSurvey>',
        f'<IndividualSurvey xmlns="{NAMESPACE}"><BirthDate xmlns="">1</BirthDate></IndividualSurvey>',
        f'<p:IndividualSurvey xmlns:p="{NAMESPACE}"><p:BirthDate>x<b>y</b>z</p:BirthDate></p:IndividualSurvey>',
        f'<Any><BirthDate xmlns="{NAMESPACE}">x</BirthDate></Any>',
    )
    assert [row.birthdate for row in rows] == [None] * 5 + ["x", "x"]


def test_store_survey_documents(frame):
    rows = store(
        frame, "<S><BankName>A</BankName></S> <X/>",
        "<S><Note><![CDATA[<BankName>no</BankName>]]></Note><BankName>A</BankName></S>",
        "<S><Note><![CDATA[<BankName>no</BankName>]]></Note></S>", "<S>\n<BankName>A<b>c</b></BankName></S>\n",
    )
    assert [row.bankname for row in rows] == [None, "A", None, "A"]


def store(frame, *documents):
    df = frame([(i, document) for i, document in enumerate(documents)], "i INT, x STRING")
    return survey.with_store_survey(df, "x").orderBy("i").collect()


def test_store_survey(frame):
    rows = store(
        frame,
        "<S xmlns='urn:s'><AnnualRevenue>$1,000.5</AnnualRevenue><Specialty>Road</Specialty></S>",
        "<S><productline> Touring </productline><A><B:annualrevenue xmlns:B='b'>7</B:annualrevenue></A></S>",
        "<S><BankName>first</BankName><BankName>A &amp;lt; B</BankName><BankName> </BankName></S>",
        "<S><YearOpened>long ago</YearOpened><NumberEmployees>12</NumberEmployees></S>",
        "<S><Specialty>Road</Specialty><ProductLine>Mountain</ProductLine></S>",
        "<S><!-- <BankName>hidden</BankName> --><BankName x='1'><![CDATA[Bank]]></BankName></S>",
        "<S><TotalAnnualSales>$5</TotalAnnualSales><AnnualSales a='/'/>9</S>",
        "<S><BankName a='>'>v &#233; &amp;amp; <![CDATA[a<b]]></BankName></S>",
        "<S><BankName>A</S>", "<S><BankName>A</BankName></S> tail", "text", None,
    )
    assert (rows[0].annualrevenue, rows[0].productline) == (1000.5, "Road")
    assert (rows[1].productline, rows[1].annualrevenue) == ("Touring", 7.0)
    assert rows[2].bankname == "A &lt; B"
    assert (rows[3].yearopened, rows[3].numberemployees) == (None, 12)
    assert rows[4].productline == "Mountain"
    assert rows[5].bankname == "Bank"
    assert rows[6].annualsales == 5.0
    assert rows[7].bankname == "v é &amp; a<b"
    for row in rows[8:]:
        assert row.bankname is None and row.annualsales is None


@pytest.mark.parametrize("document", [
    "<a>&foo;</a>", "<a b=1></a>", "<a/><b/>", "<a>\x00</a>", "<1a/>", "&", "<", "<a",
    "<?xml version='1.0' encoding='utf-16'?><a/>", "<!DOCTYPE a><a/>", "<a" * 2000, "<a>" * 500,
])
def test_no_text_stops_a_job(frame, document):
    ours = f"{document}<!-- {NAMESPACE} -->"
    assert individual(frame, document, ours)[1].birthdate is None
    assert store(frame, document, ours)[1].bankname is None
