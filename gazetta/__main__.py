"""python -m gazetta JOB --tables DIR --out DIR [--start DAY] [--end DAY] [--as-of TIME] [--limit N] [--mode MODE] [--force]"""

from __future__ import annotations

import argparse
import inspect
from datetime import datetime

from gazetta.jobs import JOBS
from gazetta.session import session
from gazetta.sources.catalog import Catalog


def arguments(job: str, given: dict) -> dict:
    """The options that a job takes, by name; dates are read as the job wants them. Others, and missing ones, are errors."""
    wanted = dict(list(inspect.signature(JOBS[job]).parameters.items())[1:])
    if unknown := given.keys() - wanted.keys():
        raise ValueError(f"{job} takes no {', '.join(sorted(unknown))}")
    if missing := [k for k, p in wanted.items() if p.default is p.empty and k not in given]:
        raise ValueError(f"{job} needs {', '.join(missing)}")
    return {k: datetime.fromisoformat(v) if wanted[k].annotation == "datetime" else v for k, v in given.items()}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="gazetta", description=__doc__)
    p.add_argument("job", choices=[*JOBS])
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    for option in ("--start", "--end", "--as-of", "--mode"):
        p.add_argument(option)
    p.add_argument("--limit", type=int)
    p.add_argument("--force", action="store_const", const=True)
    options = vars(p.parse_args(argv))
    job, tables, folder = (options.pop(k) for k in ("job", "tables", "out"))
    out = JOBS[job](Catalog(session(), tables), **arguments(job, {k: v for k, v in options.items() if v is not None}))
    for name, df in (out if isinstance(out, dict) else {job: out}).items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


if __name__ == "__main__":
    main()
