import sys

from tidemark.plans.export import main

sys.exit(main())
