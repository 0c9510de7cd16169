import os
from pathlib import Path

# Executors import the package, so their Python needs the repository on its path.
ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
