from .jobs import (grid_assignment, neighbour_assignment, neighbour_pairs, run_grid_job,
                   run_object_count_job, run_object_summary_job,
                   run_partition_job, run_strip_job, strip_assignment)

__all__ = ["grid_assignment", "neighbour_assignment", "neighbour_pairs",
           "run_grid_job", "run_object_count_job", "run_object_summary_job",
           "run_partition_job", "run_strip_job", "strip_assignment"]
