import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from conftest_llm import documents, odd_rows  # noqa: E402, F401
