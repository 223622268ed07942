import numpy as np
import pandas as pd
import pytest

from proclivity.presets import CUSTOMER_SCHEMA
from proclivity.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("OFF")
    return session


#: Log odds of a response: at the start, and what each property adds.
SIGNAL = {
    "start": -1.2, "damaged": 1.9, "insured": -2.6, "old car": 0.7, "40 to 60": 0.6,
}


#: Codes of regions and channels: any few numbers will do.
REGIONS = [float(7 * i + 2) for i in range(5)]
CHANNELS = [float(31 * i + 9) for i in range(4)]


def pick(seed, column, keys, values, shares=None):
    """A value for each key, from a generator of its own for each column."""
    draws = np.random.default_rng([seed, sum(map(ord, column))])
    return draws.choice(np.array(values), size=len(keys), p=shares)


def make_customers(n=2000, seed=0, start=0):
    """Customers whose response follows SIGNAL; `seed` decides all values."""
    keys = np.arange(start, start + n)
    out = pd.DataFrame({"id": keys})
    out["Gender"] = pick(seed, "sex", keys, ["Female", "Male"], [0.45, 0.55])
    out["Age"] = 20 + pick(seed, "age", keys, range(12)) * 5 + keys % 5
    out["Driving_License"] = pick(seed, "licence", keys, [1, 0], [0.97, 0.03])
    out["Region_Code"] = pick(seed, "region", keys, REGIONS)
    out["Previously_Insured"] = pick(seed, "insured", keys, [0, 1], [0.6, 0.4])
    out["Vehicle_Age"] = pick(
        seed, "car", keys, ["< 1 Year", "1-2 Year", "> 2 Years"], [0.4, 0.5, 0.1]
    )
    out["Vehicle_Damage"] = pick(seed, "damage", keys, ["No", "Yes"])
    out["Annual_Premium"] = np.round(
        1900 + 1000 * np.random.default_rng([seed, 1]).gamma(4.0, 7.0, n), 2
    )
    out["Policy_Sales_Channel"] = pick(seed, "channel", keys, CHANNELS)
    out["Vintage"] = 21 + (keys * 37 + seed * 11) % 268
    odds = (
        SIGNAL["start"]
        + SIGNAL["damaged"] * (out.Vehicle_Damage == "Yes")
        + SIGNAL["insured"] * out.Previously_Insured
        + SIGNAL["old car"] * (out.Vehicle_Age == "> 2 Years")
        + SIGNAL["40 to 60"] * out.Age.between(40, 60)
    )
    chance = np.random.default_rng([seed, 2]).random(n)
    out["Response"] = (np.log(chance / (1 - chance)) < odds).astype(int)
    return out


def to_spark(spark, pdf):
    casts = [
        {"string": str, "double": float}.get(f.dataType.typeName(), int)
        for f in CUSTOMER_SCHEMA
    ]
    rows = [
        tuple(
            None if pd.isna(v) else cast(v)
            for cast, v in zip(casts, row, strict=True)
        )
        for row in pdf[CUSTOMER_SCHEMA.fieldNames()].itertuples(index=False)
    ]
    return spark.createDataFrame(rows, CUSTOMER_SCHEMA)


@pytest.fixture(scope="session")
def customers_pdf():
    return make_customers()


@pytest.fixture(scope="session")
def customers(spark, customers_pdf):
    return to_spark(spark, customers_pdf).cache()
