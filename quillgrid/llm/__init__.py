"""Operators for preparing training text, and the queries that apply them.

Nothing else in the library imports this subpackage. Its functions are sent to
executors along with the tasks, so these need no copy of the code.
"""

from quillgrid.session import ship_with_tasks

ship_with_tasks(__name__)
