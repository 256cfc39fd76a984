"""Marts as one SQL text over several sources, whose tables are named by the caller."""

from __future__ import annotations

# Grades, delays, file sizes and rubric points by course. Courses, assignments and submissions come
# from a relational source, files from delimited text, feedback from documents with a nested array.
COURSE_QUALITY = """
WITH graded AS (
    SELECT a.course_id,
           ROUND(CAST(avg(CAST(s.grade AS DOUBLE)) AS DECIMAL(38, 10)), 2) AS avg_grade,
           ROUND(CAST(avg(IF(CAST(s.submitted_ts AS DATE) > a.due_dt, 1D, 0D)) AS DECIMAL(38, 10)), 3) AS late_rate
    FROM IDENTIFIER(:submissions) AS s JOIN IDENTIFIER(:assignments) AS a ON s.assignment_id = a.assignment_id
    GROUP BY a.course_id
), sized AS (
    SELECT a.course_id,
           ROUND(CAST(avg(CAST(f.size_kb AS DOUBLE)) AS DECIMAL(38, 10)), 2) AS avg_file_size_kb
    FROM IDENTIFIER(:files) AS f
    JOIN IDENTIFIER(:assignments) AS a ON CAST(f.assignment_id AS BIGINT) = a.assignment_id
    GROUP BY a.course_id
), correct AS (
    SELECT a.course_id,
           ROUND(CAST(avg(CAST(item.points AS DOUBLE)) AS DECIMAL(38, 10)), 2) AS avg_correctness_points
    FROM IDENTIFIER(:feedback) AS d
    JOIN IDENTIFIER(:submissions) AS s ON d.submission_id = s.submission_id
    JOIN IDENTIFIER(:assignments) AS a ON s.assignment_id = a.assignment_id
    LATERAL VIEW explode(d.rubric) AS item
    WHERE item.criterion = 'correctness'
    GROUP BY a.course_id
)
SELECT c.course_id, c.course_name,
       CAST(avg_grade AS DOUBLE) AS avg_grade, CAST(late_rate AS DOUBLE) AS late_rate,
       CAST(avg_file_size_kb AS DOUBLE) AS avg_file_size_kb,
       CAST(avg_correctness_points AS DOUBLE) AS avg_correctness_points
FROM IDENTIFIER(:courses) AS c
LEFT JOIN graded USING (course_id)
LEFT JOIN sized USING (course_id)
LEFT JOIN correct USING (course_id)
ORDER BY c.course_id
"""
