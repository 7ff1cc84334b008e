"""Ready-made table specifications."""

from __future__ import annotations

from rowsmith.spec import CategoryField, DateYear, NumericField, TableSpec, TargetField

# Headers, vocabularies and ranges of the Antarctic bird survey (LTER, 2007-2009).
BIRD_SURVEY = TableSpec(
    key=("row_id",),
    numeric=(
        NumericField("bill_length_mm", low=0, score_low=10, score_high=100),
        NumericField("bill_depth_mm", low=0, score_low=5, score_high=50),
        NumericField("flipper_length_mm", low=0, score_low=100, score_high=300),
        NumericField("body_mass_g", low=0, score_low=1000, score_high=10000),
        NumericField("year", "int", low=2007, high=2009),
    ),
    categorical=(
        CategoryField("island", ("Torgersen", "Biscoe", "Dream")),
        CategoryField("sex", ("MALE", "FEMALE"), null_tokens=(".",), blank_is_null=True),
    ),
    target=TargetField("species", ("Adelie", "Chinstrap", "Gentoo"), by_substring=True),
    rename={
        "Culmen Length (mm)": "bill_length_mm",
        "Culmen Depth (mm)": "bill_depth_mm",
        "Flipper Length (mm)": "flipper_length_mm",
        "Body Mass (g)": "body_mass_g",
        "Island": "island",
        "Sex": "sex",
        "Species": "species",
        "Date Egg": "date_egg",
    },
    date_year=DateYear("date_egg", "year", ("M/d/yy",)),
)
