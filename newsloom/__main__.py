import sys

from newsloom.plans.application import main

sys.exit(main(sys.argv[1:]))
