"""Hand-made lines that hold every semantic edge, with their known results."""

from __future__ import annotations

from datetime import datetime

from tillwise import schemas

_LINES = """
500001  A1  2  2011-01-10 09:00  1.50  1.0  UK
500001  A2  1  2011-01-10 09:00  2.00  1.0  UK
500001  A1  1  2011-01-10 09:01  1.50  1.0  UK
C500002 A1 -1  2011-01-12 10:00  1.50  1.0  UK
500003  A1  1  2011-09-10 08:00  1.00  2.0  UK
500004  A1  1  2011-09-09 08:00  1.00  3.0  France
500005  A1  1  2011-08-10 08:00  1.00  3.0  Germany
500006  A1 -5  2011-09-11 08:00  1.00  2.0  UK
500007  A1  1  2011-09-11 08:00  0.00  2.0  UK
C500008 A1  1  2011-09-11 08:00  1.00  2.0  UK
c500009 A1  1  2011-05-01 08:00  5.00  -    UK
500010  A1  2  2011-05-01 08:00  5.00  -    UK
-       A1  1  2011-09-10 08:00  1.00  2.0  UK
500011  A1  1  2010-01-02 08:00  3.00  4.0  UK
500012  A1  1  2011-01-02 08:00  3.00  4.0  UK
500013  A1  1  2011-01-03 08:00  3.00  4.0  UK
C500014 A1 -1  2011-02-01 08:00  1.00  5.0  UK
"""


def fixture_rows() -> list[tuple]:
    rows = []
    for line in _LINES.strip().splitlines():
        invoice, stock, quantity, day, minute, price, customer, country = (
            None if cell == "-" else cell for cell in line.split()
        )
        rows.append(
            (
                invoice,
                stock,
                "any text",
                int(quantity),
                datetime.fromisoformat(f"{day} {minute}"),
                float(price),
                None if customer is None else float(customer),
                country,
            )
        )
    return rows


def fixture_raw(spark):
    return spark.createDataFrame(fixture_rows(), schemas.RAW)
