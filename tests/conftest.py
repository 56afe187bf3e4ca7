"""Shared fixtures: one local session, and small frames with a known answer."""

from __future__ import annotations

import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from outcome_lens.contract import CENSUS  # noqa: E402
from outcome_lens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        master="local[4]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def drawn_people(number: int = 84) -> pd.DataFrame:
    """People drawn at random: longer schooling and hours make the outcome likelier; country and loss are constant."""
    rng = np.random.default_rng(20_24)
    schools = {"11th": 7, "Some-college": 10, "Assoc-voc": 11, "Masters": 14}
    school = rng.choice(list(schools), number)
    years = np.array([schools[s] for s in school])
    sex = rng.choice(["Female", "Male"], number, p=[0.45, 0.55])
    paired = rng.random(number) < 0.5
    hours = rng.integers(18, 63, number)
    eta = 0.09 * (hours - 40) + 0.5 * (years - 10) + rng.normal(0, 1, number)
    return pd.DataFrame(
        {
            "age": rng.integers(19, 71, number),
            "workclass": rng.choice(["Local-gov", "Private", "Without-pay"], number, p=[0.2, 0.7, 0.1]),
            "fnlwgt": 7_013 + 37 * np.arange(number),
            "education": school,
            "education-num": years,
            "marital-status": np.where(paired, "Married-AF-spouse", rng.choice(["Divorced", "Widowed"], number)),
            "occupation": rng.choice(["Craft-repair", "Sales", "Tech-support", "Adm-clerical"], number),
            "relationship": np.where(paired, np.where(sex == "Male", "Husband", "Wife"), "Own-child"),
            "race": rng.choice(["Other", "White", "Asian-Pac-Islander"], number),
            "sex": sex,
            "capital-gain": np.where(rng.random(number) < 0.7, 0, rng.integers(1, 90, number) * 111),
            "capital-loss": 0,
            "hours-per-week": hours,
            "native-country": "Portugal",
            "income": np.where(eta > 0, ">50K", "<=50K"),
        }
    )


@pytest.fixture(scope="session")
def drawn():
    return drawn_people()


@pytest.fixture(scope="session")
def people(spark, drawn):
    """The drawn people as a table, without a missing cell or a duplicate."""
    return spark.createDataFrame(drawn, CENSUS.schema()).cache()


@pytest.fixture
def census_file(tmp_path):
    """Two comment lines and four people with padded cells and dotted labels; the second has no work and no country."""
    rows = [
        (64, "Federal-gov", 80171, "Prof-school", 15, "Separated", "Protective-serv", "Unmarried", "Other", "Female", 0, 1721, 45, "Cuba", ">50K"),
        (23, "?", 130077, "9th", 5, "Never-married", "?", "Own-child", "White", "Male", 0, 0, 12, "?", "<=50K"),
        (47, "Self-emp-inc", 99215, "Doctorate", 16, "Divorced", "Exec-managerial", "Other-relative", "Black", "Male", 3103, 0, 58, "Italy", ">50K"),
        (35, "Private", 61740, "12th", 8, "Widowed", "Transport-moving", "Not-in-family", "White", "Female", 0, 0, 33, "Peru", "<=50K"),
    ]
    lines = ["|made for a test", *(" ,  ".join(map(str, r)) + "." for r in rows), "|the end"]
    path = tmp_path / "people.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def by(df, key: str) -> dict:
    return {r[key]: r for r in df.collect()}
