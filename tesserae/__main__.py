"""Commands: the whole chain from two CSV files, and predictions by a saved model."""

import argparse

from .plans import footprints
from .session import session


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m tesserae", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    chain = commands.add_parser("run", help="clean, match, fuse, learn and predict")
    chain.add_argument("a", nargs="?", default="data/source_a.csv")
    chain.add_argument("b", nargs="?", default="data/source_b.csv")
    chain.add_argument("out", nargs="?", default="output")
    chain.add_argument("--trees", type=int, default=400)
    again = commands.add_parser("predict", help="predict all rows of a table of features")
    again.add_argument("features", nargs="?", default="output/features")
    again.add_argument("model", nargs="?", default="output")
    again.add_argument("out", nargs="?", default="output/all_predictions")
    given = parser.parse_args(args)
    spark = session("tesserae")
    if given.command == "run":
        footprints.run(spark, given.a, given.b, given.out, given.trees)
    else:
        _, quality = footprints.predict(spark, spark.read.parquet(given.features), given.model, given.out)
        if quality is not None:
            quality.show()


if __name__ == "__main__":
    main()
