import hashlib
import json
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row, functions as F

from builders import payment, payments, some_id
from riskflow.functions import dates, fingerprint
from riskflow.functions.rules import COMPARISONS, Rule, load_rules, risk_score, score_reasons
from riskflow.operators.landing import fingerprinted


def test_prefix_is_dropped_unchecked(spark):
    frame = spark.createDataFrame([("trx_abc",), ("abcd",), ("ab",), (None,)], "v string")
    got = [r.v for r in frame.select(fingerprint.strip_prefix(F.col("v")).alias("v")).collect()]
    assert got == ["abc", "", "", None]


def test_hash_covers_the_six_fields_in_order(spark):
    rows = payments(spark, payment(1, amount=68423.46, invoice_id="INV-5", description="part 9"))
    text = f"{some_id(1)}|10000000000001|20000000000001|68423.46|INV-5|part 9"
    want = hashlib.sha256(text.encode()).hexdigest()[:32]
    assert fingerprinted(rows).first().payload_hash == want


def test_hash_ignores_time_method_and_due_date_and_is_null_for_a_null_field(spark):
    rows = payments(
        spark,
        payment(1),
        payment(1, event_timestamp="x", payment_method="TED", due_date=date(2000, 1, 1)),
        payment(1, description=None),
    )
    first, second, third = [r.payload_hash for r in fingerprinted(rows).collect()]
    assert first == second and third is None


def test_bar_in_the_last_two_fields_collides_as_documented(spark):
    rows = payments(
        spark,
        payment(1, invoice_id="a|b", description="c"),
        payment(1, invoice_id="a", description="b|c"),
    )
    assert fingerprinted(rows).select("payload_hash").distinct().count() == 1


def test_letter_case_of_an_id_changes_the_hash_but_not_the_id(spark):
    upper = f"trx_{some_id(0xABCDEF).upper()}"
    rows = payments(spark, payment(0xABCDEF), payment(transaction_id=upper))
    got = fingerprinted(rows).select("transaction_id", "payload_hash").collect()
    assert {r.transaction_id for r in got} == {some_id(0xABCDEF)}
    assert len({r.payload_hash for r in got}) == 2


def test_amount_text_styles(spark):
    frame = spark.createDataFrame([(1e7,), (12.5,), (0.123,)], "a double")
    plain = [r.t for r in frame.select(fingerprint.amount_text(F.col("a"), "plain").alias("t")).collect()]
    assert plain == ["10000000.00", "12.50", "0.123"]
    with pytest.raises(ValueError):
        fingerprint.amount_text(F.col("a"), "other")


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        ("00000000-0000-0000-0000-0000000000ab", True),
        ("00000000-0000-0000-0000-0000000000AB", True),
        ("000000000000000000000000000000ab", True),
        ("{0000-0000-0000-0000-0000-0000-0000-00ab}", True),
        ("{000000000000000000000000000000ab", False),
        ("00000000-0000-0000-0000-0000000000", False),
        ("0-0000000000000000000000000000000ab", False),
        ("not a uuid", False),
    ],
)
def test_uuid_forms(spark, text, valid):
    frame = spark.createDataFrame([(text,)], "v string")
    got = frame.select(fingerprint.canonical_uuid(F.col("v")).alias("v")).first().v
    assert got == ("00000000-0000-0000-0000-0000000000ab" if valid else None)


def test_age_is_rounded_before_it_is_compared(spark):
    as_of = date(2024, 1, 1)
    days = {0: 0.0, 346: 0.9, 347: 1.0, -30: -0.1, 3653: 10.0}
    frame = spark.createDataFrame(
        [(d, str(as_of - timedelta(days=d))) for d in days], "days int, start string"
    )
    age = dates.company_age(F.col("start"), F.lit(as_of)).cast("string")
    assert {r.days: float(r.age) for r in frame.select("days", age.alias("age")).collect()} == days


def test_malformed_start_date_fails(spark):
    frame = spark.createDataFrame([("2024-13-01",)], "start string")
    with pytest.raises(PySparkException):
        frame.select(dates.start_date(F.col("start"))).collect()


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_cache_expiry(spark, zone):
    local = ZoneInfo(dates.BUSINESS_ZONE)
    cases = [
        (datetime(2024, 3, 14, 23, 59, 59, tzinfo=local), datetime(2024, 3, 15, tzinfo=local)),
        (datetime(2024, 3, 15, 0, 0, 0, tzinfo=local), datetime(2024, 4, 15, tzinfo=local)),
        (datetime(2024, 3, 31, 12, tzinfo=local), datetime(2024, 4, 15, tzinfo=local)),
        (datetime(2024, 12, 31, 22, tzinfo=local), datetime(2025, 1, 15, tzinfo=local)),
        (datetime(2024, 3, 14, 23, 59, 59, 500_000, tzinfo=local), None),
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for now, expiry in cases:
            row = spark.range(1).select(
                F.unix_micros(dates.cache_expiry(F.lit(now))).alias("at"),
                dates.seconds_to_expiry(F.lit(now)).alias("ttl"),
            ).first()
            expiry = expiry or now + timedelta(seconds=1)
            assert row.at == round(expiry.timestamp() * 1_000_000)
            assert row.ttl == max(int((expiry - now).total_seconds()), 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_load_id_layout(spark):
    started = datetime(2024, 1, 1, 12, 0, 0, 123_000, tzinfo=timezone.utc)
    entropy = hashlib.md5(b"x").hexdigest()
    text = spark.range(1).select(
        dates.time_ordered_id(F.lit(started), F.lit(entropy)).alias("id")
    ).first().id
    import uuid

    parsed = uuid.UUID(text)
    assert parsed.version == 7 and parsed.variant == uuid.RFC_4122
    assert parsed.int >> 80 == int(started.timestamp() * 1000)


def test_elapsed_seconds_have_no_upper_limit_near_ten_thousand(spark):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    end = start + timedelta(seconds=12_345, milliseconds=678)
    row = spark.range(1).select(dates.elapsed_seconds(F.lit(start), F.lit(end)).alias("s")).first()
    assert str(row.s) == "12345.68"


# --- rules ------------------------------------------------------------------------


def test_shipped_rules_in_order():
    rules = load_rules()
    assert [(r.reason, r.points) for r in rules] == [
        ("payer_cnpj_inactive", 50),
        ("receiver_cnpj_inactive", 50),
        ("receiver_less_than_1_year", 10),
        ("payer_less_than_1_year", 10),
        ("amount_over_payer_capital", 20),
        ("amount_over_100k", 10),
    ]


@pytest.mark.parametrize("operator", sorted(COMPARISONS))
@pytest.mark.parametrize("kind", ["literal", "column"])
def test_every_operator_with_either_operand_and_nulls(spark, operator, kind):
    pairs = [(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (None, 2.0)]
    if kind == "column":
        pairs.append((1.0, None))
    operand = {"value": 2} if kind == "literal" else {"compare_column": "b"}
    rule = Rule("a", operator, 5, "hit", **operand)
    frame = spark.createDataFrame(pairs, "a double, b double")
    got = frame.select("a", "b", risk_score([rule]).alias("s"), score_reasons([rule]).alias("r")).collect()
    for row in got:
        holds = row.a is not None and row.b is not None and COMPARISONS[operator](row.a, row.b)
        assert row.s == (5 if holds else 0)
        assert row.r == ('["hit"]' if holds else "[]")


def test_column_operand_takes_precedence_and_checks_name_the_problem():
    entry = {"column": "a", "operator": ">", "points": 1, "reason": "r", "value": 3}
    assert Rule.from_mapping({**entry, "compare_column": "b"}).compare_column == "b"
    with pytest.raises(ValueError, match="'~' is none of the comparisons"):
        Rule.from_mapping({**entry, "operator": "~"})
    for key in ("column", "points", "reason", "value"):
        with pytest.raises(KeyError, match=key):
            Rule.from_mapping({k: v for k, v in entry.items() if k != key})
    with pytest.raises(ValueError, match="whole number"):
        Rule.from_mapping({**entry, "points": 1.5})


def test_reason_codes_are_escaped_and_no_rules_give_no_reasons(spark):
    odd = 'say "no", or\\not'
    rule = Rule("a", ">", 1, odd, value=0)
    frame = spark.createDataFrame([Row(a=1.0)])
    got = frame.select(
        score_reasons([rule, rule]).alias("two"), score_reasons([]).alias("none"),
        risk_score([]).alias("zero"),
    ).first()
    assert json.loads(got.two) == [odd, odd] and got.none == "[]" and got.zero == 0


def test_nan_ranks_above_every_number(spark):
    rule = Rule("a", ">", 10, "large", value=100_000)
    frame = spark.createDataFrame([(float("nan"),)], "a double")
    assert frame.select(risk_score([rule]).alias("s")).first().s == 10


@pytest.mark.parametrize("number, text", [
    (0.0, "0.0"), (1.0, "1.0"), (-12.5, "-12.5"), (9999999.99, "9999999.99"), (1e7, "10000000.0"), (1.23e7, "12300000.0"),
    (12345678.9, "12345678.9"), (-98765432.25, "-98765432.25"), (123456789012345.6, "123456789012345.6"),
    (1e15, "1000000000000000.0"), (1.5e16, "1.5e16"), (1e16, "1e16"), (2e300, "2e300"), (0.001, "0.001"), (0.0005, "0.0005"),
    (0.00012, "0.00012"), (1e-5, "1e-5"), (-2.5e-9, "-2.5e-9"), (None, None),
])
def test_positional_amounts(spark, number, text):
    from riskflow.functions.fingerprint import amount_text, positional

    row = spark.createDataFrame([(number,)], "x double").select(
        positional(F.col("x")).alias("t"), amount_text(F.col("x")).alias("d"), amount_text(F.col("x"), "shortest").alias("s")
    ).first()
    assert (row.t, row.d) == (text, text)
    assert number is None or float(row.t) == number == float(row.s)


def test_positional_text_is_what_python_writes(spark):
    import random

    from riskflow.functions.fingerprint import positional

    rnd = random.Random(6)
    numbers = [round(rnd.uniform(0, 10 ** rnd.randrange(1, 15)), 2) for _ in range(2000)]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", positional(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.x) for r in rows]


def test_rule_entries_are_checked_as_rows(spark):
    import json

    from riskflow.functions.rule_checks import RuleErrors, require_sound, rule_errors

    sound = {"column": "amount", "operator": ">", "points": 5, "reason": "r", "value": 1}
    wrong = {
        "column missing": {"column": None}, "column unknown": {"column": "colour"}, "operator unknown": {"operator": "=>"},
        "points not a whole number": {"points": 1.5}, "reason missing": {"reason": ""}, "no operand": {"value": None},
        "compare_column unknown": {"compare_column": "colour"},
    }
    entries = [(0, json.dumps(sound)), (1, json.dumps({**sound, "value": "ATIVO", "column": "payer_status"})), (2, "[]"), (3, "{"), (4, None)]
    for number, change in enumerate(wrong.values(), 10):
        entries.append((number, json.dumps({k: v for k, v in {**sound, **change}.items() if v is not None})))
    entries.append((30, json.dumps({"points": True})))
    found = {r.entry_no: r.violations for r in rule_errors(spark.createDataFrame(entries, "entry_no int, entry string")).collect()}
    assert found == {
        2: ["not an object"], 3: ["not an object"], 4: ["not an object"],
        **{number: [name] for number, name in enumerate(wrong, 10)},
        30: ["column missing", "operator missing", "points not a whole number", "reason missing", "no operand"],
    }
    require_sound(spark, [sound])
    with pytest.raises(RuleErrors, match="rule 1: operator unknown, points not a whole number"):
        require_sound(spark, [sound, {**sound, "operator": "~", "points": "5"}])


def test_the_rules_of_the_package_are_sound(spark):
    import yaml

    from riskflow.functions.rule_checks import require_sound
    from riskflow.functions.rules import DEFAULT_RULES

    require_sound(spark, yaml.safe_load(DEFAULT_RULES.read_text())["rules"])
