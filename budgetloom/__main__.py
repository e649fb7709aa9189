import sys

from budgetloom.stages import main

sys.exit(main())
