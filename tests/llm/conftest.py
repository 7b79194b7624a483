import sys
from pathlib import Path

# The pipeline's test uses the plain versions of the other tests.
sys.path.insert(0, str(Path(__file__).resolve().parent))
