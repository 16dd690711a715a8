-- Active sets and their benefits per brand and unit, on registered views.
SELECT s.empresa, u.fantasia AS unidade, count(DISTINCT s.id) AS conjuntos, count(c.id) AS coberturas
FROM insurance_reg_set s
LEFT JOIN representante r ON r.codigo = s.id_unity
LEFT JOIN catalogo u ON u.cnpj_cpf = r.cnpj_cpf
LEFT JOIN insurance_reg_set_coverage c ON c.parent = s.id AND c.empresa = s.empresa
WHERE s.id_status = :status
GROUP BY s.empresa, u.fantasia
