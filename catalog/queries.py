"""Importing this module fills the register."""

from catalog import scans  # noqa: F401
from catalog import projections  # noqa: F401
from catalog import filters  # noqa: F401
from catalog import joins  # noqa: F401
from catalog import full_books  # noqa: F401
from catalog import profiles  # noqa: F401
from catalog import bands  # noqa: F401
from catalog import quality  # noqa: F401
from catalog import policies  # noqa: F401
from catalog import preparation  # noqa: F401
from catalog import modelling  # noqa: F401
