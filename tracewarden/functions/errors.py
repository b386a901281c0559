"""Error-line predicate."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewarden.config import ERROR_WORDS


def is_error_line(line: Column, words: tuple[str, ...] = ERROR_WORDS) -> Column:
    """True when any word occurs in the lower-cased line; blank lines are never errors.

    A word that contains another listed word cannot change the outcome, so only the
    shortest ones are tested, each as a plain byte search.
    """
    wanted = [w.lower() for w in words]
    minimal = [w for w in dict.fromkeys(wanted) if not any(o != w and o in w for o in wanted)]
    lowered = F.lower(line)
    return reduce(or_, [lowered.contains(w) for w in minimal])
