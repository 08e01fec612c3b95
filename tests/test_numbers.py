import random
from decimal import Decimal, getcontext, localcontext

from pyspark.sql import functions as F

from ledgerlake.functions import numbers as N

getcontext().prec = 90


def test_hex_of_any_length(spark):
    rng = random.Random(5)
    cases = [("0x", None), ("", None), (None, None), ("0x0", "0"), ("000", "0"), ("xyz", None), (" 0xFF ", "255"), ("0xg1", None)]
    for digits in [*range(1, 66), 100, 128, 300]:
        value = rng.getrandbits(4 * digits)
        cases.append((rng.choice(["", "0x", "0X"]) + "0" * rng.randint(0, 4) + f"{value:x}", str(value)))
    cases += [(f"{16**n:x}", str(16**n)) for n in (15, 30, 31, 64)] + [(f"{16**n - 1:x}", str(16**n - 1)) for n in (15, 30, 31, 64)]
    got = spark.createDataFrame(cases, "word string, want string").withColumn("got", N.hex_to_decimal(F.col("word")))
    assert got.where("not (got <=> want)").collect() == []


def test_integer_text_and_bigint(spark):
    df = spark.createDataFrame([("0x10",), ("25",), (" ",), (None,), ("0x",), ("abc",)], "t string")
    got = df.select(N.integer_text(F.col("t")), N.to_bigint(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("16", 16), ("25", 25), (None, None), (None, None), (None, None), ("abc", None)]


def test_unit_scale(spark):
    cases = [("1500000", 6, "1.5"), ("5", 3, "0.005"), ("0", 0, "0"), ("100", 0, "100"), ("00120", 1, "12"), ("x", 1, None), (None, 1, None), ("9" * 78, 60, "9" * 18 + "." + "9" * 60)]
    df = spark.createDataFrame(cases, "v string, d int, want string")
    assert df.where(~N.unit_scale_text(F.col("v"), F.col("d")).eqNullSafe(F.col("want"))).collect() == []
    moved = [("12.5", 2, "0.125"), ("-12.5", 1, "-1.25"), ("0", 18, "0"), ("9" * 90 + ".5", 3, "9" * 87 + ".9995")]
    df = spark.createDataFrame(moved, "v string, d int, want string")
    assert df.where(~N.shift_point(F.col("v"), F.col("d")).eqNullSafe(F.col("want"))).collect() == []


def plain(number: Decimal) -> str:
    text = f"{number:f}"
    return text.rstrip("0").rstrip(".") if "." in text else text


def test_exact_amount_of_any_length(spark):
    rng = random.Random(9)
    rows = []
    with localcontext() as context:
        context.prec = 500
        for _ in range(300):
            value = Decimal(rng.randrange(10 ** rng.randint(1, 78))).scaleb(-rng.randint(0, 60))
            price = Decimal(rng.randrange(10 ** rng.randint(1, 60))).scaleb(-rng.randint(0, 30))
            rows.append((plain(value), plain(price), plain(value * price)))
        rows += [("-2.5", "4", "-10"), ("-2", "0", "0"), ("x", "1", None), (None, "1", None)]
    df = spark.createDataFrame(rows, "v string, p string, want string")
    assert df.where(~N.exact_amount(F.col("v"), F.col("p")).eqNullSafe(F.col("want"))).collect() == []


def test_add_text(spark):
    rng = random.Random(3)
    rows = []
    with localcontext() as context:
        context.prec = 500
        for _ in range(100):
            a, b = (Decimal(rng.randrange(10 ** rng.randint(1, 80))).scaleb(-rng.randint(0, 40)) for _ in "ab")
            rows.append((plain(a), plain(b), plain(a + b)))
    df = spark.createDataFrame(rows, "a string, b string, want string")
    assert df.where(~N.add_text(F.col("a"), F.col("b")).eqNullSafe(F.col("want"))).collect() == []


def test_plain_decimal(spark):
    df = spark.sql("select * from values (1e-7D, '0.0000001'), (0D, '0'), (100D, '100'), (-2.5D, '-2.5'), (1e25D, '1' || repeat('0', 25)) t(x, want)")
    assert df.where(N.plain_decimal(F.col("x")) != F.col("want")).collect() == []
    smallest = spark.sql("select cast('0.000000000000000001' as decimal(38,18)) x").select(N.plain_decimal(F.col("x")))
    assert smallest.collect()[0][0] == "0.000000000000000001"
    texts = [("1e39", "1" + "0" * 39), ("1e-20", "0." + "0" * 19 + "1"), ("-1.50E+2", "-150"), ("007", "7"), (".5", "0.5"), ("5.", "5"), ("", None), ("abc", None), ("1e", None), ("-0.0", "0")]
    df = spark.createDataFrame(texts, "x string, want string")
    assert df.where(~N.plain_decimal(F.col("x")).eqNullSafe(F.col("want"))).collect() == []


def test_sums_are_exact_at_any_size_and_in_any_order(spark):
    rng = random.Random(5)
    with localcontext() as context:
        context.prec = 600
        values = [Decimal(rng.randrange(-(10**78), 10**78)).scaleb(-rng.choice([0, 6, 18, 77, 200])) for _ in range(200)]
        want = sum(values)
        rows = [(plain(v),) for v in values] + [(None,)]
    for parts in (1, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "x string").repartition(parts)
        assert df.select(N.sum_text(F.col("x"))).collect()[0][0] == plain(want)
        assert df.select(N.sum_exact(df, "x")).collect()[0][0] == float(plain(want))
    assert df.where("false").select(N.sum_text(F.col("x"))).collect()[0][0] is None
    big = spark.sql("select cast('99999999999999999999' as decimal(38,18)) x from range(3)")
    assert big.select(N.sum_exact(big, "x")).collect()[0][0] == float("299999999999999999997")
    small = spark.sql("select 0.1BD x from range(10)")
    assert small.select(N.sum_exact(small, "x")).collect()[0][0] == 1.0


def test_sums_of_any_width(spark):
    """By key, in both signs, of numbers from 10^-400 to a 96-byte word; rows without a number count as rows."""
    import pytest

    from ledgerlake.operators import sums

    rng = random.Random(11)
    word = int("f" * 192, 16)
    rows = [("big", str(10**120)), ("big", "1"), ("word", str(word)), ("word", str(word)), ("far", "1" + "0" * 2000), ("far", "-0." + "0" * 399 + "7")]
    rows += [("none", None), ("none", None), (None, "2.5"), ("zero", "0"), ("zero", "-3"), ("zero", "3"), ("mixed", None), ("mixed", "1.5")]
    with localcontext() as context:
        context.prec = 4000
        for _ in range(200):
            x = Decimal(rng.randrange(10 ** rng.randint(1, 150))).scaleb(-rng.randint(0, 160)) * rng.choice((1, -1))
            rows.append((f"k{rng.randrange(12)}", plain(x)))
        want = {}
        for key, text in rows:
            total, n = want.get(key, (None, 0))
            want[key] = (total if text is None else (total or Decimal(0)) + Decimal(text), n + 1)
        want = {key: (None if total is None else plain(total), n) for key, (total, n) in want.items()}
        df = spark.createDataFrame(rows, "k string, x string").repartition(5)
        got = {r.k: (r.total, r.n) for r in sums.add_up(df, ["k"], "x").collect()}
        assert {key: (v if v[0] not in ("-0",) else ("0", v[1])) for key, v in want.items()} == got
    doubles = {r.k: r.total for r in sums.sum_by(df, ["k"], "x").collect()}
    assert doubles["big"] == 1e120 and doubles["none"] is None
    assert sums.add_up(df.where("false"), ["k"], "x").collect() == []
    with pytest.raises(Exception, match="room"):
        df.select(N.sum_text(F.col("x"))).collect()
