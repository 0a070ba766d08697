"""A made-up month of prices that differ by block only: answers can be computed by hand."""

from datetime import date, datetime, timedelta

from quarterlake.schema import SERIES

PRICE = {"A": 100.0, "B": 10.0, "C": 200.0}


def block(hour):
    return "B" if 8 <= hour <= 17 else "C" if 18 <= hour <= 22 else "A"


def month(spark, year=2024, mon=6, bus="REF", prices=PRICE, days=1, hours=range(24), first=1):
    rows = []
    for d in range(days):
        day = date(year, mon, first) + timedelta(days=d)
        for h in hours:
            for m in (0, 15, 30, 45):
                price = prices(h) if callable(prices) else prices[block(h)] if isinstance(prices, dict) else prices
                at = None if h == 24 else datetime(day.year, day.month, day.day, h, m)
                rows.append((bus, day, h, m, block(h), price, h == 24, at, None, "maestro_cmg_db", datetime(2026, 10, 6)))
    return spark.createDataFrame(rows, SERIES)


def dated(df):
    return df.selectExpr("*", "year(fecha) AS anio", "month(fecha) AS mes")
