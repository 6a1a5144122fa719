"""The session and tables of the other tests serve here too."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
