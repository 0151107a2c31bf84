"""Consumer price surveys as Spark DataFrames.

Pages and survey grids come in, clean long price observations come out, and
the usual questions about them (who is cheapest, how did a price move, what
did it cost on a day) are answered with DataFrame operations.
"""

from pricegrid.session import delete_scratch, get_session, scratch_dir

__all__ = ["delete_scratch", "get_session", "scratch_dir"]
