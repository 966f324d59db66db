"""``spark-submit`` entry: registry text in, clean table and 24 answers out."""

from regbook.plans.job import main

if __name__ == "__main__":
    main()
