import sys

from quillmere.cli import main

sys.exit(main())
