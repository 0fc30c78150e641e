"""python -m concordat admit | reconcile-transaction | reconcile-settlement | finalize | correct | verify.

Arguments are strict: options are written out, given once, and attempts and digests have their form.
"""

from __future__ import annotations

import argparse
import json
import re
import sys

from pyspark.sql import SparkSession

from concordat.operators.policy import check_manifest, read_policy
from concordat.plans import engine
from concordat.session import guard, local_session
from concordat.sources import files, publication
from concordat.sources.documents import read_document

ATTEMPT, DIGEST = r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}", r"[0-9a-f]{64}"


def _document(spark: SparkSession, path: str) -> dict:
    return read_document(spark, path).content


class _Once(argparse.Action):
    """An option that may be given once."""

    def __call__(self, parser, namespace, values, option_string=None):
        if getattr(namespace, self.dest, None) is not None:
            parser.error(f"{option_string} is given twice")
        setattr(namespace, self.dest, values)


def _shaped(pattern: str):
    def text(value: str) -> str:
        if not re.fullmatch(pattern, value):
            raise argparse.ArgumentTypeError(f"{value!r} is not of the form {pattern}")
        return value

    return text


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="concordat", allow_abbrev=False)
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb in ("admit", "reconcile-transaction", "reconcile-settlement", "finalize", "correct"):
        p = verbs.add_parser(verb, allow_abbrev=False)
        p.add_argument("manifest")
        p.add_argument("root", help="folder of local objects")
        p.add_argument("policy", help="policy document")
        if verb != "admit":
            p.add_argument("out", help="bundle to write, or the log's folder")
        if verb == "correct":
            p.add_argument("correction", help="correction document")
            p.add_argument("--prior-policy", action=_Once, help="policy document of the run before, if another")
        if verb in ("finalize", "correct"):
            p.add_argument("--attempt", required=True, action=_Once, type=_shaped(ATTEMPT))
            p.add_argument("--head", action=_Once, type=_shaped(DIGEST), help="digest of the entry this one follows; none for the first")
    verbs.add_parser("verify").add_argument("out")
    args = parser.parse_args(argv)
    spark = spark or local_session()
    guard(spark)
    found = {}
    try:
        if args.verb == "verify":
            said = {"entries": publication.History(spark, args.out).verify()}
        else:
            policy, manifest = read_policy(_document(spark, args.policy)), _document(spark, args.manifest)
            digest, run = check_manifest(manifest, policy), {"run_id": str(manifest.get("run_id")), "manifest_sha256": manifest["manifest_sha256"], "policy_sha256": policy.sha256}
            if args.verb in ("finalize", "correct"):
                log = publication.History(spark, args.out)
                found = files.admit_bundle(spark, manifest, args.root, policy, log.runs())
                # An attempt that was finished before gives its entry again; what follows it is not its prior state.
                prior = log.state() if log.head() and not log.attempt(args.attempt) else None
                extra = {}
                if args.verb == "correct":
                    extra = {"document": _document(spark, args.correction), "prior_policy": read_policy(_document(spark, args.prior_policy)) if args.prior_policy else None}
                said = log.attempt(args.attempt) or log.finalize(args.attempt, engine.run(spark, found, policy, digest, prior, **extra), run, args.head)
            else:
                found = files.admit_bundle(spark, manifest, args.root, policy)
                if args.verb == "admit":
                    said = {"admitted": sorted(found)}
                else:
                    tables = engine.published(engine.reconciled(found, policy, policy.permitted(spark), args.verb.removeprefix("reconcile-")))
                    said = {"manifest_sha256": publication.write_bundle(spark, tables, args.out, run)}
    except (ValueError, FileExistsError) as error:
        print(json.dumps({"refused": str(error)}), file=sys.stderr)
        return 2
    finally:
        files.release(found)
    print(json.dumps(said, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
