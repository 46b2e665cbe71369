import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from conftest_llm import clashing, no_rows, odd  # noqa: E402, F401
