"""python -m vellumark VERB ARCHIVE: plan, intake, status, census, discover, propose, freeze, read, fence, query, vectors."""

from __future__ import annotations

import argparse
import sys
from importlib import import_module

from pyspark.sql import DataFrame

from .archive import Archive
from .functions.text import shown
from .operators.charter import CharterError
from .operators.extract import Halted
from .operators.provider import Ladder, make_provider
from .operators.search import QueryError
from .operators.tape import verify_tape
from .session import build_session
from .sources.manifest import ManifestError


def report_lines(rows: list) -> list[str]:
    """A search's report for reading: each block with its document, topics, quotes by their place, and what is withheld."""
    out = [] if rows else ["no hits"]
    for k, r in enumerate(rows, 1):
        out.append(f"{k}. {shown(r['path'])} #{r['seq']}  [{shown(r['project'])}, {r['year']}]  {r['rank']:.3f}" + ("  read as one phrase" if r["matched_as"] == "phrase" else ""))
        out += [f"   topics: {shown(', '.join(r['topics']))}"] if r["topics"] else []
        out += [f"   {q['span_start']}-{q['span_end']}: {shown(q['text'])}" for q in r["quotes"]]
        out += [f"   {r['withheld']} quotes withheld: they aren't in the text"] if r["withheld"] else []
        out.append(f"   {shown(r['snippet'] or 'the text is missing')}")
    return out


def main(argv: list[str] | None = None) -> int:
    """0; 1 where an intake is incomplete or a chain is broken; 2 where a request is refused."""
    p = argparse.ArgumentParser(prog="vellumark", description=__doc__)
    p.add_argument("verb", choices=("plan", "intake", "resume", "status", "census", "discover", "propose", "freeze", "read", "fence", "query", "vectors"))
    p.add_argument("archive")
    p.add_argument("terms", nargs="?")
    p.add_argument("--limit", type=int, default=5)
    p.add_argument("--derive", action="store_true")
    p.add_argument("--first", action="store_true", help="fence the first --limit cards only")
    p.add_argument("--verify", metavar="TAPE", help="check a hash-chained log")
    p.add_argument("--sample-tokens", type=int)
    p.add_argument("--json", action="store_true")
    p.add_argument("--artifact", action="append", default=[], help="a file the charter is to rest on")
    p.add_argument("--stable", action="store_true", help="two runs of scoring agreed")
    p.add_argument("--roster", help="the file of all archives")
    p.add_argument("--provider", default="rules")
    p.add_argument("--projects", action="append")
    p.add_argument("--max-tokens", type=int, default=0)
    p.add_argument("--cap", type=float, default=1.0, help="the most dollars a pass may cost")
    p.add_argument("--max-out-tokens", type=int, default=6_000)
    p.add_argument("--concurrency", type=int, default=8, help="calls of one task at once")
    p.add_argument("--retry-quarantined", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--embedder", help="module:function of an embedder, for vectors")
    args = p.parse_args(argv)
    spark = build_session("*")
    spark.sparkContext.setLogLevel("ERROR")
    archive = Archive(spark, args.archive)

    def show(df: DataFrame) -> list:
        rows = df.toJSON().collect() if args.json else None
        if rows is None:
            df.show(200, 80)
        else:
            print("\n".join(rows))
        return rows or []

    try:
        if args.verb in ("intake", "resume"):
            states = {r["state"]: r["n"] for r in archive.intake().collect()}
            print(", ".join(f"{k} {v}" for k, v in sorted(states.items())) or "nothing")
            return int("quarantined" in states)
        if args.verb == "status":
            show(archive.status())
            if args.verify:
                bad = verify_tape(spark, args.verify)
                show(bad)
                return int(bad.limit(1).count() > 0)
            return 0
        if args.verb in ("propose", "freeze"):
            prints = archive.propose(args.artifact) if args.verb == "propose" else archive.freeze(args.stable, args.roster)
            print("\n".join(f"{v}  {k}" for k, v in sorted(prints.items())))
            return 0
        if args.verb == "read" and not args.dry_run:
            ladder = Ladder(most_out=args.max_out_tokens, threads=args.concurrency)
            print(archive.read(make_provider(args.provider), args.projects, args.max_tokens, args.retry_quarantined, most_usd=args.cap, ladder=ladder), "batches")
            return 0
        if args.verb == "vectors":
            if not args.embedder:
                raise ValueError("vectors need an --embedder")
            module, _, name = args.embedder.partition(":")
            show(archive.vectors(getattr(import_module(module), name), args.embedder))
            return 0
        if args.verb == "query" and args.terms is not None and not args.json:
            print("\n".join(report_lines(archive.query(args.terms, args.limit).collect())))  # `limit` rows
            return 0
        verbs = {"read": lambda: archive.dry_run(args.projects, args.max_tokens, args.cap), "plan": archive.plan, "census": archive.contact_sheet, "discover": lambda: archive.discover(args.sample_tokens), "fence": lambda: archive.fence(args.derive, args.limit if args.first else None), "query": lambda: archive.query(args.terms, args.limit)}
        show(verbs[args.verb]())
        return 0
    except (QueryError, ManifestError, CharterError, Halted, ValueError, FileNotFoundError) as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
