"""Run a spec file: ``python -m recordflow spec.json [--dataflow NAME]``."""

import argparse
import logging
import sys

from recordflow import CompiledFlow, FlowFailed, Spec, session_for


def main() -> int:
    parser = argparse.ArgumentParser(prog="recordflow")
    parser.add_argument("spec", help="path of a JSON spec")
    parser.add_argument("--dataflow", help="name of the dataflow; the first one by default")
    parser.add_argument("--check", action="store_true", help="only check the spec against its sources")
    arguments = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    with open(arguments.spec, encoding="utf-8") as file:
        spec = Spec.from_json(file.read())
    spark = session_for(spec.dataflow(arguments.dataflow))
    compiled = CompiledFlow(spark, spec, arguments.dataflow)
    if arguments.check:
        compiled.check()
        return 0
    try:
        report, code = compiled.run(), 0
    except FlowFailed as failure:
        report, code = failure.report, 1
    print(report.to_json())
    return code


if __name__ == "__main__":
    sys.exit(main())
