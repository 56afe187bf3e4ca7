"""The job that reports on the census income table from its two files.

    python -m outcome_lens TRAIN_CSV TEST_CSV RESULT_FOLDER [RUN_ID]
"""

from __future__ import annotations

import sys

from outcome_lens.contract import (
    CENSUS,
    CENSUS_CATEGORICAL_FEATURES,
    CENSUS_NUMERIC_FEATURES,
    AnalysisError,
)
from outcome_lens.functions.sizes import settled
from outcome_lens.operators.compare import compare_multisets
from outcome_lens.plans.conclusions import reader_equality
from outcome_lens.plans.outcome_report import ReportSpec, outcome_report
from outcome_lens.session import get_session, stored, temporary_tables
from outcome_lens.sources import normalise, parsing, read_contract, read_raw, write_results


def census_spec() -> ReportSpec:
    return ReportSpec(
        outcome=CENSUS.outcome,
        negative="<=50K",
        numeric=tuple(CENSUS_NUMERIC_FEATURES),
        categorical=tuple(CENSUS_CATEGORICAL_FEATURES),
        compared="hours-per-week",
        factor="sex",
        excluded="relationship",
        fold_keys=tuple(CENSUS.names),  # no key: equal rows were removed, so the row itself is one
        described_numeric=tuple(CENSUS.numeric),
        described_categorical=tuple(CENSUS.categorical),
        caps={f.name: f.cap for f in CENSUS.fields if f.cap is not None},
        pure_levels=("Husband", "Wife"),
        companions={"education": "education-num"},
    )


def run(train_path: str, test_path: str, result_path: str, run_id: str = "latest") -> None:
    spark = get_session("census report")
    with temporary_tables(spark):
        splits, equal = {}, []
        for split, path in (("train", train_path), ("test", test_path)):
            with parsing(path):
                # parsed once: every later step reads columns of the stored table
                splits[split] = stored(read_contract(spark, path, CENSUS), split)
                again = stored(normalise(read_raw(spark, path, CENSUS), CENSUS), f"{split}-again")
            both = compare_multisets(splits[split], again)
            write_results({f"reader_difference_{split}": both}, result_path, run_id)
            equal.append(settled(reader_equality(split, splits[split].count(), again.count(), both)))
        readers = equal[0].unionByName(equal[1])
        results = outcome_report(splits["train"], splits["test"], census_spec(), f"{result_path}/model", readers=readers)
        write_results({"readers": readers, **results}, result_path, run_id)


def main(arguments: list[str]) -> int:
    if len(arguments) not in (3, 4):
        print(__doc__)
        return 2
    try:
        run(*arguments)
    except AnalysisError as error:
        print(f"analysis failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
