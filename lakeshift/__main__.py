"""``python -m lakeshift <job> ...`` - the jobs command line (see lakeshift.plans.jobs)."""

from lakeshift.plans.jobs import main

main()
