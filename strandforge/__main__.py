"""python -m strandforge SUBCALL --option value ..."""

import sys

from pyspark.sql import SparkSession

from .config import parse_args
from .plans.stages import run


def main(args: list[str]) -> int:
    if args in (["--version"], ["-v"]):
        print("strandforge 0.1")
        return 0
    subcall, opt = parse_args(args)
    opt.check(subcall)
    spark = SparkSession.builder.appName(f"strandforge {subcall}").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    for out in run(spark, subcall, opt):
        print(out)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
