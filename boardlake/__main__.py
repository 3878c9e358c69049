import sys

from boardlake.plans.cli import main

sys.exit(main())
