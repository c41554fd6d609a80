"""Command line: ``python -m citeweave.plans.cli extract|extract-doi|normalize|build|cluster|verify|query``."""

from __future__ import annotations

import argparse
import logging

from ..operators import entities, extract
from ..session import get_session
from ..sources import works
from . import config as settings
from . import pipeline

LOG = logging.getLogger("citeweave")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citeweave", description=__doc__)
    top.add_argument("-l", "--log-level", default="INFO")
    commands = top.add_subparsers(dest="command", required=True)

    for name, group in (("extract", "--source-id"), ("extract-doi", "--member")):
        one = commands.add_parser(name, help="fields of works to long rows")
        one.add_argument("-i", "--input", required=True)
        one.add_argument("-o", "--output", default="field_data.csv")
        one.add_argument("-f", "--fields", default=extract.PIPELINE_FIELDS if name == "extract" else None, required=name != "extract")
        one.add_argument("-g", "--organize", action="store_true")
        one.add_argument("-t", "--threads", type=int, default=0, help="partitions of lines; 0: by the size of the files")
        one.add_argument("-b", "--batch-size", type=int, default=10_000, help="rows of an Arrow batch")
        one.add_argument("--max-open-files", type=int, default=100, help="accepted; rows are dealt by key before they are written")
        one.add_argument("--doi-prefix")
        one.add_argument(group, dest="group")

    one = commands.add_parser("normalize", help="long rows to author x affiliation rows")
    one.add_argument("-i", "--input", required=True)
    one.add_argument("-o", "--output")
    one.add_argument("--chunk-size", type=int, help="accepted; Spark sorts by itself")
    one.add_argument("--temp-dir")

    one = commands.add_parser("build", help="the reference table")
    one.add_argument("-r", "--references", required=True)
    one.add_argument("-d", "--database", required=True)
    one.add_argument("-m", "--memory-limit", default="8GB")
    one.add_argument("--temp-dir")
    one.add_argument("--chunk-size", type=int, help="accepted; partitions make chunks needless")
    one.add_argument("--skip-indexes", action="store_true")
    one.add_argument("--no-quoted-newlines", action="store_true", help="many tasks may read one CSV file")

    one = commands.add_parser("cluster", help="clustered copies in place of indexes")
    one.add_argument("-d", "--database", required=True)
    one.add_argument("-m", "--memory-limit", default="16GB")
    one.add_argument("--temp-dir")
    one.add_argument("--indexes", nargs="+", choices=[*pipeline.INDEXES, "all"], default=["all"])

    one = commands.add_parser("verify", help="a report on the reference table")
    one.add_argument("-d", "--database", required=True)
    one.add_argument("--sample", type=int, default=10)

    one = commands.add_parser("query", help="link and discover, or search")
    one.add_argument("-i", "--input", required=True)
    one.add_argument("-o", "--output", required=True)
    one.add_argument("-d", "--database", required=True)
    one.add_argument("-m", "--memory-limit", default="8GB")
    one.add_argument("-c", "--config", required=True)
    mode = one.add_mutually_exclusive_group(required=True)
    mode.add_argument("-p", "--process-file", action="store_true")
    mode.add_argument("-s", "--search-affiliation", action="store_true")
    one.add_argument("--no-udf", action="store_true", help="search without Python: terms beyond Latin script are left out")
    one.add_argument("--single-file", action="store_true", help="one file per result, through one task; for small results")
    one.add_argument("--entities", choices=["none", "rules"], default="none")
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    logging.basicConfig(level=args.log_level.upper())
    extra = {}
    if getattr(args, "memory_limit", None):
        extra["spark__driver__memory"] = settings.memory(args.memory_limit)
    if getattr(args, "temp_dir", None):
        extra["spark__local__dir"] = settings.checked_path(args.temp_dir, output=True)
    if getattr(args, "batch_size", None):
        extra["spark__sql__execution__arrow__maxRecordsPerBatch"] = str(args.batch_size)
    spark = get_session(**extra)
    if args.command in ("extract", "extract-doi"):
        flavour = extract.WORK if args.command == "extract" else extract.DOI
        rows = pipeline.extract_fields(spark, args.input, args.output, args.fields, flavour, args.organize, args.group, args.doi_prefix, args.threads or None)
        if rows is None:
            LOG.warning("no files below %s", args.input)
        else:
            for name, report in pipeline.extraction_summary(rows).items():
                LOG.info("%s\n%s", name, report.limit(50).toPandas().to_string(index=False))
    elif args.command == "normalize":
        LOG.info("wrote %s", pipeline.normalize_file(spark, args.input, args.output))
    elif args.command == "build":
        LOG.info("%s", pipeline.build_table(spark, args.references, args.database, cluster=not args.skip_indexes, splittable=args.no_quoted_newlines))
    elif args.command == "cluster":
        LOG.info("%s", pipeline.cluster_copies(spark, args.database, args.indexes))
    elif args.command == "verify":
        for name, report in pipeline.verify(spark, args.database, args.sample).items():
            LOG.info("%s\n%s", name, report.limit(100).toPandas().to_string(index=False))
    else:
        references = works.references(spark, f"{args.database}/author_references")
        chosen = settings.load(settings.checked_path(args.config), need_input=args.process_file)
        source, target = settings.checked_path(args.input), settings.checked_path(args.output, output=True)
        if args.process_file:
            extractor = entities.by_rules if args.entities == "rules" else entities.no_entities
            LOG.info("%s", pipeline.process_file(spark, source, target, references, chosen, extractor, args.single_file))
        elif not chosen.affiliation_name:
            raise settings.ConfigError("affiliation_search_columns needs affiliation_name")
        else:
            pipeline.search_file(spark, source, target, references, chosen.affiliation_name, args.single_file)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
