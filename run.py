"""Script for spark-submit; see ``paylake.plans.job`` for the arguments."""

from paylake.plans.job import main

if __name__ == "__main__":
    main()
