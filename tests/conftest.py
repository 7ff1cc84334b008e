import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowsmith.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    # Tiny tables need few partitions.
    session = build_session(
        "tests",
        "*",
        **{
            "spark.checkpoint.dir": shared,
            "spark.sql.shuffle.partitions": "2",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def birds(spark):
    """Synthetic clean survey rows whose measurements depend on the species."""
    # Per species: bill length, bill depth, flipper length, body mass.
    centres = {"Adelie": (38, 18.5, 190, 3700), "Chinstrap": (49, 18.5, 196, 3730), "Gentoo": (47, 15, 217, 5080)}
    rows = []
    for i in range(240):
        species = ("Adelie", "Chinstrap", "Gentoo")[i % 3]
        length, depth, flipper, mass = centres[species]
        wave = (i * 37 % 21 - 10) / 10
        rows.append(
            (
                i,
                length + wave,
                depth + wave / 4,
                float(flipper + 3 * wave),
                mass + 80 * wave if i % 20 else None,
                2007 + i % 3,
                ("Torgersen", "Biscoe", "Dream")[i % 7 % 3],
                ("MALE", "FEMALE", None)[0 if i % 5 else 2] if i % 2 else "FEMALE",
                species,
            )
        )
    return spark.createDataFrame(
        rows,
        "row_id bigint, bill_length_mm double, bill_depth_mm double, flipper_length_mm double, "
        "body_mass_g double, year int, island string, sex string, species string",
    ).coalesce(1)
