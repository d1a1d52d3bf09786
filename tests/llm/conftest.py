import os
import sys
from pathlib import Path

_HERE = Path(__file__).parent
sys.modules.pop("tests_llm_cases", None)
import importlib.util  # noqa: E402

_spec = importlib.util.spec_from_file_location("tests_llm_cases", _HERE / "cases.py")
_cases = importlib.util.module_from_spec(_spec)
sys.modules["tests_llm_cases"] = _cases
_spec.loader.exec_module(_cases)
os.environ["PYTHONPATH"] = os.pathsep.join([str(_HERE), *filter(None, [os.environ.get("PYTHONPATH")])])
